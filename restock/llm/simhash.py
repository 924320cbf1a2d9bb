"""SimHash near-duplicate groups with pigeonring candidate filtering.

A text's fingerprint has 64 bits: bit b is 1 if it is set in more than half
of the XXH64 values (seed 42) of the text's word shingles, repeats included.
Two fingerprints link at ``radius`` or fewer differing bits, and a group is a
connected component of links.

Candidates come from the pigeonring principle. The 64 bits lie on a ring of
``radius + 1`` segments. If two fingerprints differ in at most ``radius``
bits, some segment starts a chain whose first l segments differ in at most
l - 1 bits in all, for every l: the first is equal, the first two differ in
at most one bit, and so on. The first two conditions are an exact key (the
segment's value, and the next segment's value or one of its one-bit
variants), so candidates meet by a shuffle on 26 bits; the longer chains
prune them before the full Hamming distance. Fingerprints that share a key
are compared in blocks of at most ``BLOCK`` rows, a hot key's blocks in many
tasks, and only a spanning forest of each block's links leaves the task: the
links of a large group are never all written out, but no group is split.

Defined results: null, empty or word-free texts have fingerprint zero and link
like any other; fewer words than a shingle give one shingle of all words;
repeated rows are rows of their own and lie in one group; null ids are left
out of the smallest id of a group; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from restock.llm.common import components, whole_rows, with_row
from restock.session import drop_tables, materialize

SHINGLE = 4
RADIUS = 4
BLOCK = 4096


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of one text (UTF-8)."""
    words = text.lower().split()            # bytes: A-Z only, and ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_digest            # eight bytes, most significant first
    counts = np.zeros(64, np.int64)
    pairs = list(zip(starts[:n].tolist(), last.tolist()))
    for lo in range(0, n, 1 << 15):
        block = b"".join([digest(joined[a:b], 42) for a, b in pairs[lo:lo + (1 << 15)]])
        bits = np.unpackbits(np.frombuffer(block, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def _fingerprint_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint((t.as_buffer().to_pybytes() if t.is_valid else b""), shingle)
                   for t in batch.column(0).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(fps, np.uint64).view(np.int64)), batch.column(1)],
                names=["fp", "row"])
    return run


def fingerprints(docs: DataFrame, columns: list[str] | None = None, text: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """Written table (fp, row, uid) with a fingerprint for every row."""
    src = whole_rows(docs, text, columns)
    return materialize(src.mapInArrow(_fingerprint_batches(shingle), with_row("fp long", src))
                       .withColumn("uid", F.monotonically_increasing_id()), "simhash")


# ------------------------------------------------------------ candidates ----
class Ring:
    """Segments of the 64 bits, in ring order, and the chain budgets."""

    def __init__(self, radius: int):
        if not 1 <= radius <= 31:
            raise ValueError("radius must be 1 to 31")
        self.radius, m = radius, radius + 1
        edges = [64 * i // m for i in range(m + 1)]
        self.shift = [64 - b for b in edges[1:]]
        self.bits = [b - a for a, b in zip(edges, edges[1:])]
        self.width = max(self.bits)
        self.m = m

    def mask(self, i: int, length: int) -> np.uint64:
        """Bits of the chain of ``length`` segments from segment i."""
        out = 0
        for j in range(i, i + length):
            out |= ((1 << self.bits[j % self.m]) - 1) << self.shift[j % self.m]
        return np.uint64(out)

    def segment(self, fp: np.ndarray, i: int) -> np.ndarray:
        i %= self.m
        return (fp >> np.uint64(self.shift[i])) & np.uint64((1 << self.bits[i]) - 1)

    def keys(self, fp: np.ndarray) -> np.ndarray:
        """(variants, len(fp)) keys; exact says which rows are the own value."""
        out = []
        for i in range(self.m):
            own = self.segment(fp, i + 1)
            head = (np.uint64(i) << np.uint64(2 * self.width)) | (self.segment(fp, i) << np.uint64(self.width))
            out.append(head | own)
            for b in range(self.bits[(i + 1) % self.m]):
                out.append(head | (own ^ np.uint64(1 << b)))
        return np.stack(out)

    def exact(self, key: np.ndarray, fp: np.ndarray) -> np.ndarray:
        start = (key >> np.uint64(2 * self.width)).astype(int)
        low = key & np.uint64((1 << self.width) - 1)
        own = np.zeros_like(fp)
        for i in range(self.m):
            own = np.where(start == i, self.segment(fp, i + 1), own)
        return low == own

    def exact_column(self, key, fp):
        """The same as a column expression."""
        low = key.bitwiseAND(F.lit((1 << self.width) - 1))
        out = F.lit(False)
        for i in reversed(range(self.m)):
            j = (i + 1) % self.m
            own = F.shiftrightunsigned(fp, self.shift[j]).bitwiseAND(F.lit((1 << self.bits[j]) - 1))
            out = F.when(F.shiftright(key, 2 * self.width) == i, low == own).otherwise(out)
        return out


def _key_batches(ring: Ring):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for lo in range(0, len(fp), 2048):
                part = fp[lo:lo + 2048]
                keys = ring.keys(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel().view(np.int64)),
                     pa.array(np.tile(part, len(keys)).view(np.int64))], names=["key", "fp"])
    return run


def _near(ring: Ring, start: int, x: np.ndarray) -> np.ndarray:
    """Which differences pass every longer chain from ``start`` and the full distance."""
    ok = np.arange(len(x))
    for length in range(3, ring.m):
        ok = ok[np.bitwise_count(x[ok] & ring.mask(start, length)) <= length - 1]
    return ok[np.bitwise_count(x[ok]) <= ring.radius]


def forest(ring: Ring, start: int, fp: np.ndarray, exact: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links among fingerprints that share a key
    (a link needs one end whose own value is the key's)."""
    left = np.arange(len(fp))
    edges = []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            cand = left if exact[x] else left[exact[left]]
            got = cand[_near(ring, start, fp[cand] ^ fp[x])]
            if len(got):
                edges += [(x, y) for y in got.tolist()]
                queue += got.tolist()
                left = left[~np.isin(left, got)]
    return edges


def _link_batches(ring: Ring):
    """Task over rows (key, a, b, fp) sorted by the first three: forests of links."""
    def solve(key, fp, cut):
        """Links of the groups that begin at ``cut[:-1]`` (cut ends with len)."""
        exact = ring.exact(key, fp)
        start = (key >> np.uint64(2 * ring.width)).astype(int)
        size = np.diff(cut)
        two = cut[:-1][size == 2]
        left, right = [], []
        for i in range(ring.m):             # pairs, all at once
            p = two[start[two] == i]
            p = p[exact[p] | exact[p + 1]]
            ok = p[_near(ring, i, fp[p] ^ fp[p + 1])]
            left.append(fp[ok])
            right.append(fp[ok + 1])
        for lo, n in zip(cut[:-1][size > 2].tolist(), size[size > 2].tolist()):
            own = fp[lo:lo + n]
            e = forest(ring, int(start[lo]), own, exact[lo:lo + n])
            if e:
                left.append(own[[x for x, _ in e]])
                right.append(own[[y for _, y in e]])
        return (np.concatenate(left), np.concatenate(right))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None                          # rows of the group that is not over yet
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols)]
            new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:3]], axis=0)) + 1
            cut = np.concatenate(([0], new))
            rest = [c[cut[-1]:] for c in cols]
            if len(cut) > 1:
                yield batch_of(solve(cols[0].view(np.uint64), cols[3].view(np.uint64), cut))
        if rest is not None and len(rest[0]):
            yield batch_of(solve(rest[0].view(np.uint64), rest[3].view(np.uint64),
                                 np.array([0, len(rest[0])])))

    def batch_of(pair):
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in pair], names=["x", "y"])
    return run


def links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(x, y): links between distinct fingerprints of column ``fp`` that span
    every connected component of the link graph."""
    ring = Ring(radius)
    rows = fps.mapInArrow(_key_batches(ring), "key long, fp long")
    own = ring.exact_column(F.col("key"), F.col("fp"))
    w = Window.partitionBy("key")
    shared = (rows.withColumn("own", own)
              .withColumn("n", F.count("*").over(w)).withColumn("n_own", F.count_if("own").over(w))
              .where("n > 1 and n_own > 0")
              .withColumn("at", F.expr(f"cast(floor((row_number() over (partition by key order by own desc, fp) - 1) / {block}) as int)"))
              .withColumn("last", F.expr(f"cast(floor((n - 1) / {block}) as int)"))
              .withColumn("own_last", F.expr(f"cast(floor((n_own - 1) / {block}) as int)")))
    # a block meets itself, the later ones (if it has own values) and the earlier ones that have some
    pairs = shared.select("key", "fp", F.expr(
        "explode(concat(if(at <= own_last, transform(sequence(at, last), b -> struct(at as a, b as b)), array()),"
        " if(at > 0, transform(sequence(0, least(at - 1, own_last)), a -> struct(a as a, at as b)), array())))").alias("p"))
    work = (pairs.select("key", "p.a", "p.b", "fp").repartition("key", "a", "b")
            .sortWithinPartitions("key", "a", "b"))
    return work.mapInArrow(_link_batches(ring), "x long, y long").distinct()


def groups(marked: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Written table (fp, root): the group of every fingerprint that occurs."""
    fps = materialize(marked.select("fp").distinct(), "simhash-distinct")
    roots = components(links(fps, radius, block), "x", "y", "simhash")
    out = materialize(fps.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root")), "simhash-groups")
    drop_tables(fps, roots)
    return out


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(id, fingerprint, component_id) for every row."""
    marked = fingerprints(docs, [id_column], text, shingle)
    ids = marked.groupBy("fp").agg(F.min(f"row.`{id_column}`").alias("least"))
    group = groups(marked, radius).join(ids, "fp")
    least = group.groupBy("root").agg(F.min("least").alias("component_id"))
    return (marked.join(group.select("fp", "root").join(least, "root"), "fp")
            .select(F.col(f"row.`{id_column}`").alias(id_column),
                    F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The first row (smallest id, then place) of every group, all columns kept."""
    marked = fingerprints(docs, None, text, shingle)
    place = F.struct(F.col(f"row.`{id_column}`").isNull(), F.col(f"row.`{id_column}`"), F.col("uid"))
    first = marked.groupBy("fp").agg(F.min(place).alias("place"))
    keep = (groups(marked, radius).join(first, "fp").groupBy("root").agg(F.min("place").alias("place"))
            .select(F.col("place.uid").alias("uid")))
    return marked.join(keep, "uid", "left_semi").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op3: fingerprint and group of every document."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
