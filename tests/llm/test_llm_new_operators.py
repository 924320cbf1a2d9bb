"""Hard negatives, token alignment and web archives against brute force, on hard
rows: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""
import collections
import hashlib
import io
import math
import random
import struct
import zipfile

import llm_brute as B
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from restock.llm import alignment, hard_negatives, warc
from restock.llm.queries import QUERIES
from restock.session import scratch_table_path

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------ 11: hard negatives ----
def mined(rows, is_anchor, positives=5, negatives=3, low=50, high=95):
    """Rows (id, label, vector) that take part, scored one by one."""
    q = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, lab, a in {(i, lab, tuple(v)) for i, lab, v in q if is_anchor(i)}:
        scored = sorted(((-dot(a, v), j, m) for j, m, v in q if j != i))
        for s, j, _ in [x for x in scored if x[2] == lab][:positives]:
            inside = [x for x in scored if x[2] != lab and low * -s <= 100 * -x[0] <= high * -s]
            out += [(i, j, n + 1, k, -s, -t) for n, (t, k, _) in enumerate(inside[:negatives])]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int, id string, q string, g string, score string, `a.b` int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", "y", "z", "s", 1) for i, lab, v in rows], VECTORS).repartition(3)


def got_rows(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_residues_give_exact_scores():
    r = np.random.default_rng(0)
    for size, depth in ((150, 64), (2**20, 64), (2**22, 200), (1, 3)):
        a, b = r.integers(-size, size + 1, (7, depth)), r.integers(-size, size + 1, (9, depth))
        primes = hard_negatives.primes_for(depth * size * size)
        got = hard_negatives.scores(hard_negatives.residues(a, primes), hard_negatives.residues(b, primes), primes)
        assert got.tolist() == (a.astype(object) @ b.astype(object).T).tolist()
    edge = np.full((1, 64), 2**25), np.full((1, 64), -2**25)
    primes = hard_negatives.primes_for(64 * 2**50)
    assert hard_negatives.scores(hard_negatives.residues(edge[0], primes), hard_negatives.residues(edge[1], primes), primes)[0, 0] == -64 * 2**50


def test_mining_equals_brute_force(spark):
    r = random.Random(2)
    rows = [(i, r.randrange(4), [round(r.gauss(0.1, 0.2), 3) for _ in range(9)]) for i in range(300)]
    rows += [(i, 1, [0.25] * 9) for i in range(300, 330)]                       # ties
    rows += [(11, 2, rows[11][2]), rows[17], rows[17], rows[50], rows[50]]      # an id again, repeated rows, a repeated anchor
    rows += [(400, 3, []), (401, 3, [0.5, 0.5]), (450, 3, [-9.0] * 9)]          # shorter vectors, an anchor far off
    bad = [(None, 1, [0.1] * 9), (2, None, [9.0] * 9), (3, 1, None), (4, 1, [None] + [9.0] * 8), (5, 1, [float("nan")] * 9),
           (6, 1, [float("inf")] * 9), (100, 1, [float("-inf")] * 9), (7, 1, [3e30] * 9)]
    got = hard_negatives.mine(vectors(spark, rows + bad), F.col("id") % 25 == 0)
    assert got_rows(got) == mined([x for x in rows], lambda i: i % 25 == 0)
    assert got_rows(hard_negatives.mine(vectors(spark, rows), F.col("id") % 100 == 0, positives=2, negatives=7, low=10, high=100)) == \
        mined(rows, lambda i: i % 100 == 0, 2, 7, 10, 100)


def test_mining_small_parts(spark, monkeypatch):
    """Many row and anchor parts, many tiles."""
    for name, v in (("PART", 40), ("LEAST", 20), ("TILE_A", 3), ("TILE_R", 7)):
        monkeypatch.setattr(hard_negatives, name, v)
    r = random.Random(3)
    rows = [(i, r.randrange(3), [r.gauss(0.1, 0.2) for _ in range(70)]) for i in range(210)]
    assert got_rows(hard_negatives.mine(vectors(spark, rows), F.col("id") % 2 == 0)) == mined(
        [(i, lab, [float(np.float32(x)) for x in v]) for i, lab, v in rows], lambda i: i % 2 == 0)


def test_mining_nothing(spark):
    none = vectors(spark, [])
    for rows in (none, vectors(spark, [(1, 1, [0.5])]), vectors(spark, [(50, 1, [0.5])]), vectors(spark, [(50, 1, [0.5]), (51, 1, [0.5])])):
        got = hard_negatives.mine(rows, F.col("id") % 50 == 0)
        assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and got.count() == 0


# ------------------------------------------------------------ 12: alignment ----
@pytest.fixture(scope="module")
def files():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        a = f.read()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return a, f.read()


@pytest.fixture(scope="module")
def libraries(files):
    a = Tokenizer.from_str(files[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_proto=files[1])


def aligned(libraries, docs):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, digest) a row of (id, text), link by link."""
    tk, sp = libraries
    letters = alignment.byte_letters()
    known, count = {}, collections.Counter()
    for _, text in docs:
        if not text:
            continue
        if text not in known:
            a, b = tk.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
            x = [bytes(letters[c] for c in tk.id_to_token(i)) for i in a]
            y = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if not b"".join(x) == b"".join(y) == (" " + text).encode():
                known[text] = None
                continue
            groups, i, j, at, bt, left, right = [], 0, 0, 0, 0, [], []
            while i < len(a) or j < len(b):
                if at <= bt and i < len(a):
                    at, i, left = at + len(x[i]), i + 1, [*left, a[i]]
                else:
                    bt, j, right = bt + len(y[j]), j + 1, [*right, b[j]]
                if at == bt:
                    groups.append((left, right))
                    left, right = [], []
            known[text] = len(a), len(b), groups, [(p, q) for g, h in groups for p in g for q in h]
        if known[text]:
            count.update(set(known[text][3]))
    top = {}
    for (p, _), n in count.items():
        top[p] = max(top.get(p, 0), n)
    out = []
    for d, text in docs:
        k = known.get(text) if text else None
        if not k:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        digest = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in k[2])
        out.append((d, k[0], k[1], len(k[2]), len(k[3]), sum(count[p] == top[p[0]] for p in k[3]), sum(count[p] for p in k[3]),
                    hashlib.sha256(digest.encode()).hexdigest()))
    return out


DOCS = "doc_id long, text string, key string, pairs string, copies long, n_a string, row string, `a.b c` string"


def hard_docs():
    t = B.texts() + ["<|endoftext|> and <s> </s> <unk>", "a▁b", "ﬁ ½ ﷺ é", "word " * 3000, "a" * 5000, " " * 3000, "　 x  y\t\tz\r\n", "é" * 900]
    rows = [(7 * i, x) for i, x in enumerate(t)]
    return rows + [rows[20], (None, "a text of its own"), (3, rows[30][1]), (None, None)]


def key(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_alignment_equals_brute_force(spark, files, libraries):
    docs = hard_docs()
    df = spark.createDataFrame([(d, t, "k", "p", 5, "n", "r", "x") for d, t in docs], DOCS).repartition(3)
    want = key(aligned(libraries, docs))
    assert sum(r[1] == 0 for r in want) >= 3 and len({r[5] for r in want}) > 20
    for most in (alignment.FREQUENT, 50, 1, 0):        # all pairs by broadcast, some, none
        got = alignment.alignment(df, *files, most=most)
        assert key(tuple(r) for r in got.select("row.doc_id", *alignment.MEASURES, "groups_sha256").collect()) == want
    assert got.select("row.*").columns == df.columns


def test_alignment_of_large_groups(files, libraries, monkeypatch):
    """Groups linked by distinct ids give the same pairs and times as link by link."""
    pair = alignment.Pair(*files)
    texts = [t.encode() for _, t in hard_docs() if t]
    plain = [(n, p.tolist(), k.tolist()) for n, *_, p, k in alignment.align(pair, texts)]
    monkeypatch.setattr(alignment, "LARGE_GROUP", 1)
    assert [(n, p.tolist(), k.tolist()) for n, *_, p, k in alignment.align(pair, texts)] == plain


def test_ranks_equal_the_library(files, libraries):
    pair = alignment.Pair(*files)
    for _, t in hard_docs():
        if t:
            assert pair.a.encode_ordinary(" " + t) == libraries[0].encode(" " + t, add_special_tokens=False).ids, t[:50]
    with pytest.raises(ValueError):
        alignment.byte_bpe_ranks(files[0].replace('"ByteLevel"', '"Whitespace"'))


def test_alignment_of_nothing(spark, files):
    for rows in ([], [(1, None), (2, ""), (2, "")]):
        df = spark.createDataFrame([(d, t, "k", "p", 5, "n", "r", "x") for d, t in rows], DOCS)
        got = alignment.alignment(df, *files, columns=["doc_id"])
        assert sorted(tuple(r) for r in got.select("row.doc_id", *alignment.MEASURES, "groups_sha256").collect()) == [(d, 0, 0, 0, 0, 0, 0, "") for d, _ in rows]


def test_alignment_query(spark, libraries):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in QUERIES["op12_alignment"](spark, SF).select("doc_id", *alignment.MEASURES, "groups_sha256").collect()]
    assert sorted(got) == sorted(aligned(libraries, docs))


# ----------------------------------------------------------------- 13: WARC ----
PAGES = "page_id long, url string, html string, digest string, first long, size string, path string, `a.b` int"


def pages():
    long = "<p>" + "x" * 120
    rows = [(5, "http://b.example/1", long), (2, "https://b.example:80/2?q=1#f", long), (9, None, long), (1, "http://a.example", None),
            (3, "u\r\nWARC-Type: evil", ""), (4, "http://é.example/ü", "short"), (6, "x", "short"), (7, "y", "é" * 50), (8, "z", "é" * 50),
            (10, "", "a" * 99), (11, "", "a" * 99), (12, "http://c.example", "WARC/1.1\r\n\r\nPK\x05\x06" * 30), (13, "q", "long " * 200_000),
            (None, "n", long), (None, "n", "only without id" * 10), (None, "n", "only without id" * 10), (2, "again", long), (14, "g", "\0" * 300)]
    return rows


def told(rows):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        to = first.get(h) if len(b) >= 100 and first.get(h) != i else None
        out.append((str(i) if i is not None else "", len(b), hashlib.sha256(b).hexdigest(), "response" if to is None else "revisit",
                    None if to is None else str(to)))
    return sorted(out, key=str)


def page_table(spark, rows):
    return spark.createDataFrame([(i, u, h, "d", 0, "s", "p", 1) for i, u, h in rows], PAGES).repartition(3)


def test_warc_round_trip(spark):
    rows = pages()
    for limit in (warc.PACKAGE, 2000):                 # one package a task, many
        kept = warc.write(page_table(spark, rows), scratch_table_path(spark, "warc-test"), limit=limit)
        assert kept.agg(F.sum("n_records")).first()[0] == len(rows)
        back = warc.read(kept)
        got = back.select("record_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
        assert sorted((tuple(r) for r in got), key=str) == told(rows)
        bodies = {r.record_id: bytes(r.payload) for r in back.where("record_type = 'response' and record_id != ''").collect()}
        assert all(bodies[str(i)] == (h or "").encode() for i, _, h in rows if str(i) in bodies)
        assert back.where("record_type = 'revisit' and payload is not null").count() == 0
        urls = {r.record_id: r.target_uri for r in back.collect()}
        assert urls["9"] is None and urls["3"] == "u%0D%0AWARC-Type:%20evil" and urls["4"] == "http://é.example/ü"


def test_warc_empty_table(spark):
    kept = warc.write(page_table(spark, []), scratch_table_path(spark, "warc-test"))
    assert kept.count() == 0 and warc.read(kept).count() == 0


class Bytes:
    """Random access to bytes, counting what is read."""

    def __init__(self, data):
        self.data, self.read = data, 0

    def read_at(self, n, at):
        self.read += n
        return self.data[at:at + n]


def package(n=50, index=True, gz_index=False):
    p, bodies = warc.Package(), []
    for i in range(n):
        body = f"<html>{i}".encode() * (i + 1)
        bodies.append(body)
        p.add("response", f"http://h{i % 7}.example/{i}", "d", warc.record("response", str(i), "u", body, len(body), "d"))
    return p, bodies


def zipped(p, force=False, index="plain", comment=b"", stored=True):
    out = io.BytesIO()
    lines = "".join(sorted(p.lines)).encode()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED if stored else zipfile.ZIP_DEFLATED) as z:
        members = [("pages/pages.jsonl", b"{}\n" * 10)]
        if index == "plain":
            members.append((warc.INDEX, lines))
        elif index == "gz":
            import gzip
            members.append((warc.INDEX + ".gz", gzip.compress(lines[:500]) + gzip.compress(lines[500:])))
        members.append((warc.DATA, p.data.getvalue()))
        for name, data in members:
            with z.open(zipfile.ZipInfo(name), "w", force_zip64=force) if stored else z.open(name, "w") as f:
                f.write(data)
        z.comment = comment
    return out.getvalue()


@pytest.mark.parametrize("kw", [{}, {"force": True}, {"index": "gz"}, {"index": "none"}, {"comment": b"PK\x05\x06 a comment " * 50}])
def test_packages_are_located_and_range_read(kw, monkeypatch):
    p, bodies = package()
    data = zipped(p, **kw)
    monkeypatch.setattr(warc, "READ", 300)             # many small ranges
    src = Bytes(data)
    if b"PK" not in kw.get("comment", b""):            # the library takes such a comment for an end record
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            assert [(m.name, m.size) for m in warc.directory(src, len(data))] == [(i.filename, i.file_size) for i in z.infolist()]
    found = list(warc.located(src, len(data)))
    assert len(found) == 50
    got = sorted((int(r.record_id), r.payload) for r in (warc.parse(data[o:o + n]) for _, o, n in found))
    assert got == list(enumerate(bodies))


def as_zip64(data: bytes) -> bytes:
    """The same package with its end record's and directory's values moved to ZIP64 records."""
    at = data.rfind(b"PK\5\6")
    n, size, begin = struct.unpack_from("<HII", data, at + 10)
    entries, pos = b"", begin
    for _ in range(n):
        head = bytearray(data[pos:pos + 46])
        packed, plain, a, b, c = struct.unpack_from("<IIHHH", head, 20)
        local, = struct.unpack_from("<I", head, 42)
        extra = struct.pack("<HHBB", 0x5455, 2, 1, 2) + struct.pack("<HHQQQ", 1, 24, plain, packed, local)
        struct.pack_into("<IIHH", head, 20, 0xFFFFFFFF, 0xFFFFFFFF, a, len(extra))
        struct.pack_into("<I", head, 42, 0xFFFFFFFF)
        entries += bytes(head) + data[pos + 46:pos + 46 + a] + extra
        pos += 46 + a + b + c
    end64 = b"PK\6\6" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, len(entries), begin)
    locator = b"PK\6\7" + struct.pack("<IQI", 0, begin + len(entries), 1)
    end = b"PK\5\6" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    return data[:begin] + entries + end64 + locator + end


def test_zip64_directory(monkeypatch):
    p, bodies = package()
    data = as_zip64(zipped(p))
    with zipfile.ZipFile(io.BytesIO(data)) as z:       # the library agrees that it is one
        names = z.namelist()
    monkeypatch.setattr(warc, "READ", 64)
    assert [m.name for m in warc.directory(Bytes(data), len(data))] == names
    found = list(warc.located(Bytes(data), len(data)))
    assert sorted(warc.parse(data[o:o + n]).payload for _, o, n in found) == sorted(bodies)


def test_what_is_no_package():
    p, _ = package(3)
    assert list(warc.located(Bytes(zipped(p, stored=False)), len(zipped(p, stored=False)))) == []      # compressed members
    for bad in (b"", b"PK", b"x" * 100, zipped(p)[:-30], zipped(p)[40:]):
        with pytest.raises((ValueError, struct.error)):
            list(warc.located(Bytes(bad), len(bad)))


def test_locating_reads_little_of_a_package():
    p, _ = package(20)
    p.data.write(b"\0" * 5_000_000)                    # records are not touched to be located
    data = zipped(p)
    src = Bytes(data)
    assert len(list(warc.located(src, len(data)))) == 20 and src.read < 200_000


def test_packages_from_elsewhere(spark, tmp_path):
    p, bodies = package()
    for i, kw in enumerate(({"force": True}, {"index": "none"})):
        (tmp_path / f"p{i}.zip").write_bytes(zipped(p, **kw))
    paths = spark.createDataFrame([(f"file:{tmp_path}/p{i}.zip",) for i in range(2)], "path string")     # a Hadoop-like URI
    got = warc.read(paths).collect()
    assert len(got) == 100 and {bytes(r.payload) for r in got} == set(bodies)


# ------------------------------------------------ 9: items that share windows ----
def test_shared_windows_write_hits_and_items_not_their_product(spark):
    """2,001 items of one short text over 200 documents: the lists are written once."""
    from restock.llm import decontaminate
    bench = spark.range(2001).select(F.concat(F.lit("q"), F.col("id")).alias("item_id"), F.lit("alpha beta gamma").alias("text"))
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("x alpha beta gamma y alpha beta gamma").alias("text"))
    marked, matches = decontaminate.mark(docs, bench)
    assert matches.rows.count() == 400 and matches.lists.count() == 1
    got = decontaminate.report(marked, matches)
    assert got.where("n_hit = 6 and size(items) = 2001").count() == 200


def test_filters_follow_the_benchmark():
    from restock.llm import decontaminate
    assert [decontaminate.filter_bits(n) for n in (0, 1, 64, 20_000, 10**6, 10**9)] == [16, 16, 17, 25, 30, 30]
