"""SHA-256 of files of any length, read by Spark's own readers, so wherever those reach."""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import groups
from ..session import settle

#: Files of so many bytes at most are hashed as one value.
WHOLE = 16 << 20
#: Longer files are read as stretches between separators; a stretch and its separator have fewer bytes than this.
STRETCH = 16 << 20
#: Bytes that are shuffled as one row.
PIECE = 1 << 16
#: What a file that has a longer stretch is read by next.
SEPARATORS = ("\n", "\0", " ", ",")
#: Names by which text readers would unpack a file; its bytes are read as they are.
PACKED = (".gz", ".bz2", ".deflate", ".snappy", ".lz4", ".zst", ".zstd")
#: Text readers drop these bytes from the start of a file.
MARK = b"\xef\xbb\xbf"

_URI = "_metadata.file_path"


def sha256_files(spark: SparkSession, root: str) -> DataFrame:
    """`path`, `length` and `sha256` of every file below `root`.

    A long file is read as lines, in splits, which whole tasks share. They pass as pieces in the file's order through one
    task, which holds a batch of them: the hash is sequential, its memory does not depend on the file. The bytes are counted, so
    a line that the reader left out for its length is noticed, and the file is read again by another separator. One
    that has a stretch of `STRETCH` bytes for each of them is hashed as one value.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)

    def at_once(some: DataFrame) -> DataFrame:
        return some.select("path", "length", F.sha2("content", 256).alias("sha256"))

    short = at_once(files.filter(F.col("length") <= WHOLE))
    long = settle(files.filter(F.col("length") > WHOLE).select("path", "length", F.col(_URI).alias("_uri")))
    packed = F.coalesce(*[F.when(F.col("_uri").endswith(s), s) for s in PACKED], F.lit(""))
    suffixes = [r[0] for r in long.select(packed).distinct().collect()]
    if not suffixes:
        return short
    found, left = None, None
    for separator in SEPARATORS:
        lines = [_lines(spark, root, separator, s, left) for s in suffixes]
        hashed = settle(_hashed(reduce(DataFrame.unionByName, lines)))
        found = hashed if found is None else found.unionByName(hashed)
        # few files, if any
        left = [r[0] for r in long.join(found, "_uri", "left_anti").select("_uri").collect()]
        if not left:
            break
    known = long.join(found, "_uri").select("path", "length", "sha256")
    out = short.unionByName(known)
    return out.unionByName(at_once(files.filter(F.col(_URI).isin(left)))) if left else out


def _lines(spark: SparkSession, root: str, separator: str, suffix: str, only: list[str] | None) -> DataFrame:
    """Lines of the long files whose names end in `suffix` (empty: in none that is unpacked), each with its separator."""
    reader = spark.read.option("recursiveFileLookup", True).option("lineSep", separator).option("mapreduce.input.linerecordreader.line.maxlength", STRETCH)
    mine = F.col(_URI).endswith(suffix)
    if suffix:
        reader = reader.option("io.compression.codecs", "org.apache.hadoop.io.compress.PassthroughCodec")
        # Spark's own build of Hadoop has the second name
        for name in ("io.compress.passthrough.extension", "org.apache.hadoop.shaded.io.compress.passthrough.extension"):
            reader = reader.option(name, suffix)
    else:
        for s in PACKED:
            mine = mine & ~F.col(_URI).endswith(s)
    if only is not None:
        mine = mine & F.col(_URI).isin(only)
    return reader.text(root).filter((F.col("_metadata.file_size") > WHOLE) & mine).select(
        F.col(_URI).alias("_uri"), F.col("_metadata.file_size").alias("_size"), F.col("_metadata.file_block_start").alias("_from"),
        F.concat(F.col("value").cast("binary"), F.lit(separator.encode())).alias("_line"),
    )


def _hashed(lines: DataFrame) -> DataFrame:
    """`_uri` and `sha256` of the files whose bytes are all there."""
    most = PIECE

    def pieces(batches):
        n = 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            ends = np.append(groups._starts(table, ["_uri", "_from"]), table.num_rows)
            for a, b in zip(ends[:-1], ends[1:]):
                line = batch["_line"].slice(a, b - a).cast(pa.large_binary())
                _, offsets, data = line.buffers()
                offsets = np.frombuffer(offsets, np.int64)[line.offset : line.offset + len(line) + 1]
                cuts = np.append(np.arange(offsets[0], offsets[-1], most), offsets[-1])
                own = data.slice(offsets[0], offsets[-1] - offsets[0])
                cut = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts - offsets[0]).astype(np.int32)), own])
                same = table.slice(a, 1).select(["_uri", "_size", "_from"]).take(np.zeros(len(cut), np.int64))
                yield from same.append_column("_n", pa.array(np.arange(n, n + len(cut)))).append_column("_piece", cut).combine_chunks().to_batches()
                n += len(cut)

    def hashes(batches):
        uri, file = None, None
        for batch in batches:
            for name, size, piece in zip(batch["_uri"].to_pylist(), batch["_size"].to_pylist(), batch["_piece"]):
                if name != uri:
                    if file:
                        yield from file.row(uri)
                    uri, file = name, _File(size)
                file.add(piece.as_buffer())
        if file:
            yield from file.row(uri)

    cut = lines.mapInArrow(pieces, "_uri string, _size long, _from long, _n long, _piece binary")
    ordered = cut.repartition(F.xxhash64("_uri")).sortWithinPartitions("_uri", "_from", "_n")
    return ordered.mapInArrow(hashes, "_uri string, sha256 string")


class _File:
    """The hash of one file from its pieces; the last one waits, as the file need not end in a separator."""

    def __init__(self, size: int):
        self.size, self.read, self.last = size, 0, b""
        self.plain, self.marked = hashlib.sha256(), hashlib.sha256(MARK)

    def add(self, piece) -> None:
        for h in (self.plain, self.marked):
            h.update(self.last)
        self.last, self.read = piece, self.read + len(memoryview(piece))

    def row(self, uri: str):
        """Nothing where bytes are missing."""
        cut, marked = next(((cut, m) for m in (False, True) for cut in (0, 1) if self.read - cut + len(MARK) * m == self.size), (None, None))
        if cut is None:
            return
        h = self.marked if marked else self.plain
        h.update(memoryview(self.last)[: len(memoryview(self.last)) - cut])
        yield pa.RecordBatch.from_pydict({"_uri": [uri], "sha256": [h.hexdigest()]})
