"""Power spectra over bounded segments, and whole-session smoothers."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..session import settle
from . import blocks, groups, stats
from .asof import interpolate



def fill_linear(df: DataFrame, k: Sequence[str], v: str, i: str = "i", block: int = blocks.BLOCK_ROWS) -> DataFrame:
    """Missing values on the line between their neighbours, the nearest value at the ends."""
    cut = df.withColumn("_b", F.floor(F.col(i) / block).cast("bigint"))
    point = F.when(F.col(v).isNotNull(), F.struct(F.col(i).cast("double").alias("_t"), F.col(v).alias(v)))
    seen = blocks.scan(cut, k, "_b", [i], prev={"_p": point}, following={"_n": point})
    filled = interpolate(F.col(i).cast("double"), F.col("_p"), F.col("_n"), v)
    return seen.withColumn(v, F.coalesce(F.col(v), filled)).drop("_p", "_n", "_b")


def segments(df: DataFrame, k: Sequence[str], v: str, size: int, step: int, i: str = "i") -> DataFrame:
    """Complete windows of `size` samples every `step`: k, seg, x (array of exactly `size`)."""
    first = F.greatest(F.ceil((F.col(i) - size + 1) / F.lit(step)), F.lit(0)).cast("bigint")
    last = F.floor(F.col(i) / F.lit(step)).cast("bigint")
    spread = df.filter(F.col(v).isNotNull() & (first <= last)).select(
        *k, i, v, F.explode(F.sequence(first, last)).alias("seg")
    )
    packed = spread.groupBy(*k, "seg").agg(F.collect_list(F.struct(i, v)).alias("_x")).filter(F.size("_x") == size)
    return packed.select(*k, "seg", F.transform(F.sort_array("_x"), lambda s: s[v]).alias("x"))


def _hann(n: int, periodic: bool) -> np.ndarray:
    return 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / (n if periodic else n - 1))


def _power(x: np.ndarray, fs: float, nfft: int, periodic: bool = True) -> np.ndarray:
    """One-sided Hann periodograms of the rows of x."""
    w = _hann(x.shape[1], periodic)
    p = np.abs(np.fft.rfft(x * w, n=nfft, axis=1)) ** 2 / (fs * np.sum(w**2))
    p[:, 1:-1] *= 2
    return p


def centred(df: DataFrame, k: Sequence[str], v: str) -> DataFrame:
    """Values minus their session's mean."""
    mean = df.groupBy(*k).agg(F.avg(v).alias("_mean"))
    return stats.attach(df, mean, k).withColumn(v, F.col(v) - F.col("_mean")).drop("_mean")


def welch_psd(
    df: DataFrame, k: Sequence[str], v: str, size: int = 4096, overlap: float = 0.5, fs: float = 25.0, i: str = "i",
    by: Sequence[str] = (),
) -> DataFrame:
    """Power density averaged over all windows of all sessions (F1), or per `by` key.

    Windows never cross a session. Each Arrow batch of windows is reduced to one summed spectrum
    per key before anything is shuffled.
    """
    by = list(by)
    step = round(size * (1 - overlap))
    wins = segments(centred(df, k, v), k, v, size, step, i).select(*by, "x")
    schema = ", ".join([f"`{c}` {wins.schema[c].dataType.simpleString()}" for c in by] + ["n bigint", "p array<double>"])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            groups = pdf.groupby(by, sort=False) if by else [((), pdf)]
            rows = []
            for key, part in groups:
                p = _power(np.stack(part["x"].to_numpy()), fs, size)
                rows.append((*key, len(part), p.sum(axis=0).tolist()))
            yield pd.DataFrame(rows, columns=[*by, "n", "p"])

    sums = wins.mapInPandas(partial, schema)
    bins = sums.select(*by, "n", F.posexplode("p").alias("bin", "_p"))
    return bins.groupBy(*by, "bin").agg(F.sum("n").alias("n_segments"), (F.sum("_p") / F.sum("n")).alias("psd")).withColumn(
        "freq_hz", F.col("bin") * (fs / size)
    )


# Edges of the reported frequency bands, in Hz.
BAND_EDGES = (0.0, 0.5, 1.0, 1.5, 1.92, 2.0, 3.0, 5.0, 12.5)


def band_energy(psd: DataFrame, edges: Sequence[float] = BAND_EDGES, by: Sequence[str] = ()) -> DataFrame:
    """Share of power per band [lo, hi) (F2)."""
    total = psd.groupBy(*by).agg(F.sum("psd").alias("_all"))
    bands = F.inline(F.array(*[F.struct(F.lit(a).alias("lo_hz"), F.lit(b).alias("hi_hz")) for a, b in zip(edges, edges[1:])]))
    placed = psd.select(*by, "freq_hz", "psd", bands)
    inside = (F.col("freq_hz") >= F.col("lo_hz")) & (F.col("freq_hz") < F.col("hi_hz"))
    sums = placed.groupBy(*by, "lo_hz", "hi_hz").agg(F.sum(F.when(inside, F.col("psd")).otherwise(0.0)).alias("_in"))
    return stats.attach(sums, total, by).select(*by, "lo_hz", "hi_hz", F.try_divide(F.col("_in") * 100, F.col("_all")).alias("pct_power"))


def cumulative_power(psd: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of power up to each frequency (F2); a spectrum has size / 2 + 1 rows."""
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy("bin")
    upto = F.sum("psd").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return psd.select(*by, "bin", "freq_hz", F.try_divide(upto * 100, F.sum("psd").over(Window.partitionBy(*by))).alias("cum_pct"))


def spectrogram(
    df: DataFrame, k: Sequence[str], v: str, win: int = 256, overlap: float = 0.9, nfft: int = 512, fs: float = 25.0, i: str = "i"
) -> DataFrame:
    """Power per window and frequency (F3): k, seg, t_s (centre of the window), bin, freq_hz, power.

    The session mean is removed first; the window is the symmetric Hann.
    """
    step = win - round(win * overlap)
    wins = segments(centred(df, k, v), k, v, win, step, i)

    @F.pandas_udf("array<double>")
    def power(x: pd.Series) -> pd.Series:
        return pd.Series(list(_power(np.stack(x.to_numpy()), fs, nfft, periodic=False)))

    return wins.select(
        *k, "seg", ((F.col("seg") * step + win / 2) / fs).alias("t_s"), F.posexplode(power("x")).alias("bin", "power")
    ).withColumn("freq_hz", F.col("bin") * (fs / nfft))


def spectrum(df: DataFrame, k: Sequence[str], v: str, start: int, n: int, fs: float = 25.0, i: str = "i") -> DataFrame:
    """Plain magnitude spectrum of one stretch of `n` samples, its mean removed."""
    stretch = df.filter(F.col(i).between(start, start + n - 1)).withColumn("_j", F.col(i) - start)
    wins = segments(stretch, k, v, n, n, "_j")

    @F.pandas_udf("array<double>")
    def magnitude(x: pd.Series) -> pd.Series:
        a = np.stack(x.to_numpy())
        return pd.Series(list(np.abs(np.fft.rfft(a - a.mean(axis=1, keepdims=True), axis=1))))

    return wins.select(*k, F.posexplode(magnitude("x")).alias("bin", "magnitude")).withColumn("freq_hz", F.col("bin") * (fs / n))


def filter_metrics(df: DataFrame, k: Sequence[str], raw: str, filtered: Sequence[str], adopted: str, baseline: Column, event: Column) -> DataFrame:
    """Noise in a quiet stretch, its reduction, the peak kept in an event, and the correlation with
    the adopted filter, for each filtered column (F5)."""
    noise = F.stddev_samp(F.when(baseline, F.col(raw)))
    peak = F.max(F.when(event, F.abs(raw)))
    rows = [
        F.struct(
            F.lit(c).alias("filter"),
            F.col(f"_s_{c}").alias("noise_sd"),
            ((1 - F.try_divide(F.col(f"_s_{c}"), F.col("_s"))) * 100).alias("noise_reduction_pct"),
            (F.try_divide(F.col(f"_p_{c}"), F.col("_p")) * 100).alias("peak_retained_pct"),
            F.col(f"_r_{c}").alias("r_adopted"),
        )
        for c in filtered
    ]
    aggs = [noise.alias("_s"), peak.alias("_p")]
    for c in filtered:
        aggs += [
            F.stddev_samp(F.when(baseline, F.col(c))).alias(f"_s_{c}"),
            F.max(F.when(event, F.abs(c))).alias(f"_p_{c}"),
            F.corr(c, adopted).alias(f"_r_{c}"),
        ]
    return df.groupBy(*k).agg(*aggs).select(*k, F.inline(F.array(*rows)))


def haar_basis(level: int) -> np.ndarray:
    """Orthonormal Haar basis of 2**level samples: row 0 is constant, the others are differences of neighbouring halves."""
    basis = np.ones((1, 1))
    for _ in range(level):
        basis = np.vstack([np.kron(basis, [1.0, 1.0]), np.kron(np.eye(len(basis)), [1.0, -1.0])]) / math.sqrt(2.0)
    return basis


def haar_denoise(df: DataFrame, k: Sequence[str], v: str, out: str, level: int = 4, i: str = "i", block: int = blocks.BLOCK_ROWS) -> DataFrame:
    """Soft-threshold Haar denoising.

    A Haar transform of `level` steps mixes only groups of 2**level samples, so the groups are
    independent once the session's threshold is known: a median of the finest details. The filled
    series is read several times and is written once.
    """
    k = list(k)
    size = 1 << level
    root = math.sqrt(2.0)
    whole = settle(fill_linear(df.select(*k, i, v), k, v, i, block))
    ends = whole.groupBy(*k).agg(F.count(F.lit(1)).alias("_n"), F.max_by(v, i).alias("_last"))
    padded = F.ceil(F.col("_n") / size) * size
    pair = whole.groupBy(*k, F.floor(F.col(i) / 2).alias("_pair")).agg(
        F.max(F.when(F.col(i) % 2 == 0, F.col(v))).alias("_a"), F.max(F.when(F.col(i) % 2 == 1, F.col(v))).alias("_z")
    )
    # an odd last sample is paired with its own copy; further padding pairs are zeros
    details = stats.attach(pair, ends, k).select(*k, ((F.col("_a") - F.coalesce("_z", "_last")) / root).alias("_d"))
    extra = F.floor((padded - F.col("_n")) / 2)
    zeros = ends.filter(extra > 0).select(*k, F.explode(F.sequence(F.lit(1), extra.cast("int"))).alias("_z")).select(
        *k, F.lit(0.0).alias("_d")
    )
    scale = stats.mad(details.unionByName(zeros), k, "_d", "_med", "_mad")
    facts = ends.join(scale, k).select(
        *k, "_last", (F.col("_mad") / 0.6745 * F.sqrt(F.ln(F.greatest(padded, F.lit(2)).cast("double")) * 2)).alias("_thr")
    )
    groups = whole.groupBy(*k, F.floor(F.col(i) / size).alias("_g")).agg(F.sort_array(F.collect_list(F.struct(i, v))).alias("_s"))
    ready = stats.attach(groups, facts, k).withColumn(
        "_x", F.concat(F.transform("_s", lambda s: s[v]), F.array_repeat("_last", size - F.size("_s")))
    )

    basis = haar_basis(level)

    @F.pandas_udf("array<double>")
    def denoise(x: pd.Series, thr: pd.Series) -> pd.Series:
        part = np.stack(x.to_numpy()) @ basis.T
        detail = part[:, 1:]
        part[:, 1:] = detail - np.clip(detail, -thr.to_numpy(float)[:, None], thr.to_numpy(float)[:, None])
        return pd.Series(list(part @ basis))

    done = ready.withColumn("_y", denoise("_x", "_thr")).select(
        *k, F.inline(F.arrays_zip(F.transform("_s", lambda s: s[i]).alias(i), F.slice("_y", 1, F.size("_s")).alias(out)))
    )
    return df.join(done, [*k, i])


def fft_lowpass(
    df: DataFrame, k: Sequence[str], v: str, cutoff: float, out: str, fs: float = 25.0, i: str = "i", block: int = blocks.BLOCK_ROWS,
) -> DataFrame:
    """Zero-phase low-pass of a whole series: frequencies above `cutoff` are removed.

    Series of up to `FFT_VALUES` rows are transformed whole, many in one call; longer ones are filtered by the equal circular
    convolution, whose transforms are split over the cluster.
    """
    k = list(k)
    whole = fill_linear(df.select(*k, i, v), k, v, i, block)
    sized = settle(stats.attach(whole, whole.groupBy(*k).agg(F.count(F.lit(1)).alias("_n")), k))
    smooth = _lowpass_whole(sized.filter(F.col("_n") <= FFT_VALUES), k, v, cutoff, out, fs, i)
    long = sized.filter(F.col("_n") > FFT_VALUES)
    if long.limit(1).count():
        smooth = smooth.unionByName(_lowpass_split(long, k, v, cutoff, out, fs, i))
    return df.join(smooth, [*k, i])


def _lowpass_whole(sized: DataFrame, k, v, cutoff, out, fs, i) -> DataFrame:
    """Each series transformed at its own length."""
    rows = sized.select(*k, F.col(i).cast("bigint").alias(i), F.col(v).cast("double").alias("_v"))

    def smooth(whole: pa.Table, starts: np.ndarray) -> pa.Table:
        place, x = whole[i].to_numpy(), whole["_v"].to_numpy()
        j, y = np.zeros(len(x), np.int64), np.zeros(len(x))
        for a, b in zip(starts[:-1], starts[1:]):
            n, inside = int(b - a), place[a:b] < b - a
            series = np.zeros(n)
            series[place[a:b][inside]] = x[a:b][inside]
            kept = np.fft.rfft(series)
            kept[min(int(math.floor(cutoff * n / fs)), n // 2) + 1 :] = 0
            j[a:b], y[a:b] = np.arange(n), np.fft.irfft(kept, n)
        return whole.select(k).append_column(i, pa.array(j)).append_column(out, pa.array(y, from_pandas=True))

    schema = StructType([*(sized.schema[c] for c in k), StructField(i, LongType()), StructField(out, DoubleType())])
    return groups.over_groups(rows, k, [i], smooth, schema)


def _lowpass_split(sized: DataFrame, k, v, cutoff, out, fs, i) -> DataFrame:
    """y = x convolved circularly with the kernel of the kept frequencies.

    The kernel of N samples with m0 kept frequencies on each side is a Dirichlet kernel. Padded to
    a power of two, the circular convolution of length N is a product of three transforms.
    """
    n = F.col("_n")
    m0 = F.least(F.floor(F.lit(cutoff) * n / fs), F.floor(n / 2))
    # an even series that keeps its highest frequency counts that one once
    whole_band = (m0 * 2 >= n)
    angle = F.lit(math.pi) * F.col("_d") / n
    kernel = F.when(whole_band, F.when(F.col("_d") == 0, 1.0).otherwise(0.0)).otherwise(
        F.when(F.col("_d") == 0, (m0 * 2 + 1) / n).otherwise(F.sin(angle * (m0 * 2 + 1)) / (n * F.sin(angle)))
    )
    m = F.pow(F.lit(2.0), F.ceil(F.log2(n * 2 - 1))).cast("bigint")
    data = sized.withColumn("_m", m)
    signal = data.select(*k, "_n", "_m", F.col(i).alias("j"), F.col(v).alias("re"), F.lit(0.0).alias("im"))
    # the kernel at lag d and at lag d - N, which is place M + d - N
    lags = data.withColumn("_d", F.col(i)).select(*k, "_n", "_m", F.col(i).alias("_d"), kernel.alias("re"))
    placed = lags.select(
        *k, "_n", "_m", F.explode(F.array_compact(F.array(F.col("_d"), F.when(F.col("_d") > 0, F.col("_m") + F.col("_d") - F.col("_n"))))).alias("j"), "re", F.lit(0.0).alias("im")
    )
    a = split_fft(signal, k).select(*k, "_n", "_m", "j", F.col("re").alias("ar"), F.col("im").alias("ai"))
    b = split_fft(placed, k).select(*k, "j", F.col("re").alias("br"), F.col("im").alias("bi"))
    product = a.join(b, [*k, "j"]).select(
        *k, "_n", "_m", "j", (F.col("ar") * F.col("br") - F.col("ai") * F.col("bi")).alias("re"),
        (-(F.col("ar") * F.col("bi") + F.col("ai") * F.col("br"))).alias("im"),
    )
    # the transform of the conjugate is the conjugate of the inverse, up to 1 / M
    back = split_fft(product, k)
    return back.filter(F.col("j") < F.col("_n")).select(*k, F.col("j").alias(i), (F.col("re") / F.col("_m")).alias(out))


FFT_VALUES = 1 << 18  # values that one call transforms


def split_fft(df: DataFrame, k: Sequence[str]) -> DataFrame:
    """Discrete transform of long series: k, _n, _m (length, a power of two), j, re, im.

    With M = P * Q and j = Q * p + q, the series becomes Q transforms of length P, a phase per value and P transforms of
    length Q. Missing places are zeros. A call takes as many of them as make `FFT_VALUES` values, so it never holds more
    than that or sqrt(2 M), and a short series is two calls.
    """
    k = list(k)
    keys = [*k, "_n", "_m"]
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keys)

    def pieces(m: int) -> tuple[int, int]:
        q = 1 << int(math.floor(math.log2(m) / 2))
        return m // q, q

    def first(pdf: pd.DataFrame) -> pd.DataFrame:
        m = int(pdf["_m"].iloc[0])
        p_len, q_len = pieces(m)
        q, row = np.unique(pdf["_q"].to_numpy(), return_inverse=True)
        x = np.zeros((len(q), p_len), complex)
        x[row, (pdf["j"] // q_len).to_numpy()] = pdf["re"].to_numpy() + 1j * pdf["im"].to_numpy()
        at = np.arange(p_len)
        y = (np.fft.fft(x, axis=1) * np.exp(-2j * np.pi * (np.outer(q, at) % m) / m)).reshape(-1)
        head = {c: [pdf[c].iloc[0]] * len(y) for c in keys}
        return pd.DataFrame(head | {"_p": np.tile(at, len(q)), "_q": np.repeat(q, p_len), "re": y.real, "im": y.imag})

    def second(pdf: pd.DataFrame) -> pd.DataFrame:
        p_len, q_len = pieces(int(pdf["_m"].iloc[0]))
        p, row = np.unique(pdf["_p"].to_numpy(), return_inverse=True)
        x = np.zeros((len(p), q_len), complex)
        x[row, pdf["_q"].to_numpy()] = pdf["re"].to_numpy() + 1j * pdf["im"].to_numpy()
        y = np.fft.fft(x, axis=1).reshape(-1)
        head = {c: [pdf[c].iloc[0]] * len(y) for c in keys}
        return pd.DataFrame(head | {"j": (p[:, None] + p_len * np.arange(q_len)[None, :]).reshape(-1), "re": y.real, "im": y.imag})

    q_len = F.pow(F.lit(2.0), F.floor(F.log2("_m") / 2)).cast("bigint")
    columns = df.withColumn("_q", F.pmod(F.col("j"), q_len)).withColumn("_g", F.floor(F.col("_q") * (F.col("_m") / q_len) / FFT_VALUES))
    inner = columns.groupBy(*k, "_g").applyInPandas(first, f"{schema}, _p bigint, _q bigint, re double, im double")
    inner = inner.withColumn("_g", F.floor(F.col("_p") * q_len / FFT_VALUES))
    return inner.groupBy(*k, "_g").applyInPandas(second, f"{schema}, j bigint, re double, im double")


def compare_smoothers(df: DataFrame, k: Sequence[str], columns: dict[str, DataFrame], v: str, i: str = "i") -> DataFrame:
    """Put several smoothed versions of a channel side by side for `filter_metrics`."""
    return reduce(lambda a, b: a.join(b, [*k, i]), [d.select(*k, i, c) for c, d in columns.items()], df)


def smoother(kind: str, k: Sequence[str], fs: float = 25.0, cutoff: float = 2.0):
    """A smoother for `rules.label_v2`: "fft" or "haar", on both accelerations."""

    def apply(df: DataFrame) -> DataFrame:
        base = settle(df)
        out = base
        for v, name in (("lon_acc_g", "lon_smooth"), ("lat_acc_g", "lat_smooth")):
            narrow = base.select(*k, "i", v)
            smooth = fft_lowpass(narrow, k, v, cutoff, name, fs) if kind == "fft" else haar_denoise(narrow, k, v, name)
            out = out.join(smooth.drop(v), [*k, "i"])
        return settle(out)

    return apply
