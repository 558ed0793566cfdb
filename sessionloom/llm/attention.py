"""A small causal self-attention model over subword ids, in numpy: one layer, one head, a two-part output.

The next id is predicted as a class and an id within it: softmax over the classes from the attended state, then the id's share of its
class in the training corpus. Frequent ids have classes of their own. Documents are read in overlapping windows: a window shows `SEEN`
ids before those it scores, and every id is scored by exactly one window.
"""

from __future__ import annotations

import numpy as np

DIM = 16
HIDDEN = 32
CLASSES = 64
SLOTS = 4096
SCORED = 24
SEEN = 8
WIDTH = SCORED + SEEN
#: Windows that training lays out at a time.
HELD = 4096

SHAPES = {"emb": (SLOTS + 1, DIM), "pos": (WIDTH, DIM), "qkv": (DIM, 3 * DIM), "out": (DIM, DIM), "up": (DIM, HIDDEN), "down": (HIDDEN, DIM), "cls": (DIM, CLASSES), "bias": (CLASSES,)}
ONES = np.ones(max(WIDTH, CLASSES), np.float32)
SCALE = np.float32(DIM**-0.5)
CAUSAL = np.where(np.arange(WIDTH)[None, :] <= np.arange(SEEN, WIDTH)[:, None], 0, -1e9).astype(np.float32)


def start(seed: int = 0) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    p = {k: (draw.normal(0, 0.1 if k in ("emb", "pos") else s[0] ** -0.5, s)).astype(np.float32) for k, s in SHAPES.items()}
    p["bias"][:] = 0
    return p


class Ids:
    """What the corpus' counts of ids decide: slots of the embedding, classes, and each id's share of its class."""

    def __init__(self, counts: np.ndarray):
        # counts: by id, the last one is the end of a text; one is added to each
        c = counts.astype(np.float64) + 1
        order = np.argsort(-c, kind="stable")
        rank = np.empty(len(c), np.int64)
        rank[order] = np.arange(len(c))
        self.slot = np.where(rank < SLOTS // 2, rank, SLOTS // 2 + rank % (SLOTS // 2)).astype(np.int32)
        # half of the classes are single ids, the others have equal shares of the rest
        single = CLASSES // 2
        cls = np.minimum(rank, single)
        rest = order[single:]
        share = np.cumsum(c[rest]) / c[rest].sum()
        cls[rest] = single + np.minimum((share * (CLASSES - single) - 1e-9).astype(np.int64), CLASSES - single - 1)
        self.cls = cls.astype(np.int32)
        self.inside = np.log(c / np.bincount(cls, c, minlength=CLASSES)[cls]).astype(np.float32)
        self.prior = np.log(np.bincount(cls, c, minlength=CLASSES) / c.sum() + 1e-12).astype(np.float32)


def numbered(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(own, nth): the text of every window and its number within it; the end of a text is scored too."""
    many = -(-(np.diff(first) + 1) // SCORED)
    own = np.repeat(np.arange(len(many)), many)
    return own, np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many)


def windows(ids: np.ndarray, first: np.ndarray, know: Ids, end: int, pick: tuple[np.ndarray, np.ndarray] | None = None):
    """(slots, pad, target ids, valid, own): every window of the texts ids[first[i]:first[i + 1]], or those that `pick` has as (own, nth)."""
    size = np.diff(first) + 1
    own, nth = numbered(first) if pick is None else pick
    # place p of a text reads id p - 1 (the start mark at 0) and scores id p
    place = nth[:, None] * SCORED - SEEN + np.arange(WIDTH)[None, :]
    at = first[:-1][own][:, None] + place
    n = size[own][:, None]
    inside = (place >= 0) & (place < n)
    flat = ids if len(ids) else np.zeros(1, ids.dtype)
    read = flat[np.clip(at - 1, 0, len(flat) - 1)]
    slots = np.where(place == 0, SLOTS, know.slot[read])
    slots[~inside] = SLOTS
    target = np.where(place == n - 1, end, flat[np.clip(at, 0, len(flat) - 1)])[:, SEEN:]
    return slots, np.where(place < 0, np.float32(-1e9), np.float32(0)), target, inside[:, SEEN:], own


def forward(p, slots, pad):
    """Every state up to the logits. Sums along rows are products with ones, here and in `gradients`: numpy adds up short rows slowly."""
    b = len(slots)
    x = np.take(p["emb"], slots, axis=0)
    x += p["pos"]
    qkv = (x.reshape(-1, DIM) @ p["qkv"]).reshape(b, WIDTH, 3 * DIM)
    q, k, v = qkv[:, SEEN:, :DIM] * SCALE, qkv[:, :, DIM : 2 * DIM], qkv[:, :, 2 * DIM :]
    a = np.matmul(q, k.transpose(0, 2, 1))
    a += CAUSAL
    early = np.flatnonzero(pad[:, 0])
    if len(early):
        a[early] += pad[early][:, None, :]
    np.exp(np.minimum(a, 30, out=a), out=a)
    a /= (a.reshape(-1, WIDTH) @ ONES[:WIDTH] + np.float32(1e-9)).reshape(b, SCORED, 1)
    mixed = np.matmul(a, v).reshape(-1, DIM)
    h0 = mixed @ p["out"]
    h0 += x[:, SEEN:].reshape(-1, DIM)
    up = h0 @ p["up"]
    np.maximum(up, 0, out=up)
    h = up @ p["down"]
    h += h0
    logits = h @ p["cls"]
    logits += p["bias"]
    return x, q, k, v, a, mixed, h0, up, h, logits


def infer(p, slots, pad):
    """The logits of `forward`, with fewer passes over memory: only rows that need it are masked, and sums divide the mixed values."""
    b = len(slots)
    x = p["emb"][slots]
    x += p["pos"]
    seen = x[:, SEEN:].reshape(-1, DIM)
    kv = (x.reshape(-1, DIM) @ p["qkv"][:, DIM:]).reshape(b, WIDTH, 2 * DIM)
    q = (seen @ (p["qkv"][:, :DIM] * np.float32(DIM**-0.5))).reshape(b, SCORED, DIM)
    a = np.matmul(q, kv[:, :, :DIM].transpose(0, 2, 1))
    a += CAUSAL
    early = np.flatnonzero(pad[:, 0])
    a[early] += pad[early][:, None, :]
    np.exp(np.minimum(a, 30, out=a), out=a)
    mixed = np.matmul(a, kv[:, :, DIM:]).reshape(-1, DIM)
    mixed /= a.reshape(-1, WIDTH).sum(axis=1)[:, None] + np.float32(1e-9)
    h = seen + mixed @ p["out"]
    up = h @ p["up"]
    h += np.maximum(up, 0, out=up) @ p["down"]
    logits = h @ p["cls"]
    logits += p["bias"]
    return logits


def log_probabilities(p, know: Ids, ids, first, end, batch: int = 64) -> np.ndarray:
    """Natural logarithm of every text's probability. A batch is small enough for the caches; the windows are laid out `HELD` at a time."""
    own, nth = numbered(first)
    total = np.zeros(len(first) - 1)
    ones = np.ones(CLASSES, np.float32)
    row = np.arange(batch * SCORED)
    for base in range(0, len(own), HELD):
        pick = own[base : base + HELD]
        slots, pad, target, valid, _ = windows(ids, first, know, end, (pick, nth[base : base + HELD]))
        cls, inside = know.cls[target].reshape(len(pick), -1), know.inside[target]
        got = np.empty(target.shape, np.float32)
        for lo in range(0, len(slots), batch):
            s = slice(lo, lo + batch)
            logits = infer(p, slots[s], pad[s])
            want = logits[row[: len(logits)], cls[s].reshape(-1)]
            np.exp(logits, out=logits)
            got[s] = (want - np.log(logits @ ones)).reshape(-1, SCORED)
        got += inside
        total += np.bincount(pick, np.where(valid, got, 0).sum(axis=1, dtype=np.float64), minlength=len(total))
    return total


class Flat:
    """One array for all parameters but the embedding, and a view of it for each, so that a step of Adam is a few passes over one array."""

    def __init__(self):
        names = [k for k in SHAPES if k != "emb"]
        cut = np.cumsum([0] + [int(np.prod(SHAPES[k])) for k in names])
        self.all = np.zeros(cut[-1], np.float32)
        self.of = {k: self.all[a:b].reshape(SHAPES[k]) for k, a, b in zip(names, cut[:-1], cut[1:])}


def softmax(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(e, sums), in place: e / sums is the softmax of each row. Rows are moved by their largest logits where these are far from 0."""
    if max(logits.max(), -logits.min()) > 60:
        logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    return logits, logits @ ONES[: logits.shape[1]]


def gradients(p, slots, pad, target_cls, valid, g: dict[str, np.ndarray] | None = None):
    """(g, dx): the mean loss' gradients, written to the arrays `g` if there are any, and those of the places' inputs."""
    x, q, k, v, a, mixed, h0, up, h, logits = forward(p, slots, pad)
    b = len(slots)
    if g is None:
        g = {name: np.empty_like(p[name]) for name in SHAPES if name != "emb"}
    d, sums = softmax(logits)
    share = valid / np.float32(max(np.count_nonzero(valid), 1))
    d *= (share / sums)[:, None]
    d[np.arange(len(d)), target_cls] -= share
    np.matmul(h.T, d, out=g["cls"])
    np.sum(d, axis=0, out=g["bias"])
    dh = d @ p["cls"].T
    np.matmul(up.T, dh, out=g["down"])
    dup = dh @ p["down"].T
    dup *= up > 0
    np.matmul(h0.T, dup, out=g["up"])
    dh += dup @ p["up"].T
    np.matmul(mixed.T, dh, out=g["out"])
    dm = dh @ p["out"].T
    # the sum of da * a along a row is that of dm * mixed
    along = (dm * mixed) @ ONES[:DIM]
    dm = dm.reshape(b, SCORED, DIM)
    ds = np.matmul(dm, v.transpose(0, 2, 1))
    ds -= along.reshape(b, SCORED, 1)
    ds *= a
    dqkv = np.empty((b, WIDTH, 3 * DIM), x.dtype)
    dqkv[:, :SEEN, :DIM] = 0
    np.multiply(np.matmul(ds, k), SCALE, out=dqkv[:, SEEN:, :DIM])
    np.matmul(ds.transpose(0, 2, 1), q, out=dqkv[:, :, DIM : 2 * DIM])
    np.matmul(a.transpose(0, 2, 1), dm, out=dqkv[:, :, 2 * DIM :])
    dqkv = dqkv.reshape(-1, 3 * DIM)
    np.matmul(x.reshape(-1, DIM).T, dqkv, out=g["qkv"])
    dx = (dqkv @ p["qkv"].T).reshape(b, WIDTH, DIM)
    dx[:, SEEN:] += dh.reshape(b, SCORED, DIM)
    np.sum(dx, axis=0, out=g["pos"])
    return g, dx


def train(p, know: Ids, ids, first, end, batch: int = 16, rate: float = 0.01, seed: int = 0):
    """One pass of Adam over the texts' windows in random order; returns the parameters and the number of windows. Windows are laid
    out `HELD` at a time, so that memory goes with the ids alone; their slots are sorted there too, by step."""
    own, nth = numbered(first)
    now_, mean, square, grad = Flat(), Flat(), Flat(), Flat()
    for k, v in now_.of.items():
        v[:] = p[k]
    emb, seen = p["emb"].copy(), np.zeros_like(p["emb"])
    p = now_.of | {"emb": emb}
    theta, m, s, g = now_.all, mean.all, square.all, grad.all
    order = np.random.default_rng(seed).permutation(len(own))
    steps, held = -(-len(order) // batch), HELD // batch
    for base in range(0, steps, held):
        pick = order[base * batch : (base + held) * batch]
        slots, pad, target, valid, _ = windows(ids, first, know, end, (own[pick], nth[pick]))
        cls, low = know.cls[target], slots.astype(np.uint16)
        for step in range(base, min(base + held, steps)):
            at = slice((step - base) * batch, (step - base + 1) * batch)
            _, dx = gradients(p, slots[at], pad[at], cls[at].reshape(-1), valid[at].reshape(-1), grad.of)
            now, t = rate * (1 - step / steps) + rate / 50, step + 1
            m += np.float32(0.1) * (g - m)
            s += np.float32(0.01) * (g * g - s)
            down = np.sqrt(s * np.float32(1 / (1 - 0.99**t)))
            down += np.float32(1e-6)
            np.divide(m, down, out=down)
            down *= np.float32(now / (1 - 0.9**t))
            theta -= down
            # only the rows that were read move
            key = low[at].reshape(-1)
            by = np.argsort(key, kind="stable")
            key = key[by]
            head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            rows = key[head]
            d = np.add.reduceat(dx.reshape(-1, DIM)[by], head, axis=0)
            root = seen[rows]
            root += d * d
            seen[rows] = root
            np.sqrt(root, out=root)
            root += np.float32(1e-6)
            d *= np.float32(now * 5)
            d /= root
            emb[rows] -= d
    return {k: p[k].copy() for k in SHAPES}, len(order)


def pack(p) -> bytes:
    return b"".join(p[k].astype("<f4").tobytes() for k in SHAPES)


def unpack(b: bytes) -> dict[str, np.ndarray]:
    flat, out, at = np.frombuffer(b, "<f4"), {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k] = flat[at : at + n].reshape(s).copy()
        at += n
    return out
