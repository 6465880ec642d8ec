"""Archives, conversation repair and whitening against brute force, round trips and numpy."""

from __future__ import annotations

import gzip
import hashlib
import itertools
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from airlake.llm import conversations, warc, whitening
from airlake.llm.queries import ORACLE, QUERIES
from checks.compare import compare, connect
from tests.conftest import SMALL


@pytest.mark.parametrize("name", ["op11_warc", "op12_conversation_repair"])
def test_query_agrees_with_its_sql(spark, name):
    assert compare(spark, connect(SMALL), SMALL, name, QUERIES[name], ORACLE[name]) == ""


# Archives -----------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, archive string, chunk int, holder long, last boolean"


@pytest.fixture(scope="module")
def pages(spark):
    long = "".join(f"<p>é{i}</p>" for i in range(90_000))
    rows = [
        (1, "http://a.example/x y\r\nWARC-Type: no", "k" * 1000), (2, None, "k" * 1000), (3, "u", "k" * 999),
        (4, "u", "k" * 999), (5, "http://ß.example/?q=1#f", long), (6, "u", long), (7, "u", None), (8, "u", ""),
        (9, "u", "z" * 2000), (9, "u", "z" * 2000), (None, "u", "z" * 2000), (None, "u", "only " * 300),
        (10, "u", "WARC/1.1\r\n\r\n" * 100), (11, "u", "k" * 1000 + "é"), (9, "u", "other"),
    ]
    return spark.createDataFrame([(*r, "x", 1, 2, None) for r in rows], PAGES).repartition(3)


def expected_records(rows):
    holders = {}
    for page, html in rows:
        if page is not None:
            holders[html or ""] = max(page, holders.get(html or "", page))
    for page, html in rows:
        data, holder = (html or "").encode(), holders.get(html or "")
        again = len(data) >= 1000 and holder is not None and page != holder
        yield page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", holder if again else None


def test_archives_come_back(spark, pages, rows):
    given = [(r["page_id"], r["html"]) for r in pages.collect()]
    assert rows(warc.archived_pages(pages)) == sorted(expected_records(given), key=repr)


def test_chunks_are_the_payloads(spark, pages, tmp_path, monkeypatch):
    folder, index = warc.write_archives(pages, f"file:{tmp_path}/archives", archive_bytes=100_000)
    found = warc.read_chunks(spark, folder).collect()
    assert index.count() == pages.count() and index.select("archive").distinct().count() > 3
    assert max(len(r["data"] or b"") for r in found) == warc.CHUNK_BYTES
    whole = {}
    for r in sorted(found, key=lambda r: r["chunk"]):
        if r["record_type"] == "response":
            key = (r["page_id"], r["archive"])
            whole.setdefault(key, []).append((r["chunk"], r["data"], r["payload_bytes"], r["payload_digest"]))
    big = next(parts for (page, _), parts in whole.items() if page == 6)
    assert [p[0] for p in big] == list(range(len(big))) and len(big) > 3
    read = b""
    for _, data, size, digest in big:
        read += data
        assert (size, digest) == (len(read), hashlib.sha1(read).hexdigest())
    assert read == pages.where("page_id = 6").first()["html"].encode()
    # Every record is a gzip member of its own, where the index says.
    for r in index.collect():
        with open(f"{tmp_path}/archives/{r['archive']}", "rb") as file:
            file.seek(r["offset"])
            record = gzip.decompress(file.read(r["length"]))
        head, _, block = record.partition(b"\r\n\r\n")
        lines = head.decode("ascii").split("\r\n")
        assert lines[0] == "WARC/1.1" and f"WARC-Type: {r['record_type']}" in lines
        assert len([line for line in lines if line.startswith("WARC-Type")]) == 1
        size = int(next(line for line in lines if line.startswith("Content-Length"))[15:])
        assert len(block) == size + 4 and block.endswith(b"\r\n\r\n")


def test_a_chunked_table_is_archived_like_its_pages(spark, pages, tmp_path, rows):
    """Payloads given as chunk rows in any order, cut anywhere, come back as the payloads of whole pages."""
    whole = pages.where("page_id not in (9, 10)")
    data = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    cut = whole.where("page_id is not null").select("page_id", "url", data.alias("all")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.floor(F.octet_length("all") / 70_001).cast("int")))
    )
    last = F.col("chunk") == F.floor(F.octet_length("all") / 70_001)
    chunks = cut.select(
        "page_id", "url", "chunk", last.alias("last"), F.substring("all", F.col("chunk") * 70_001 + 1, F.lit(70_001)).alias("data")
    )
    folder, index = warc.archive_chunks(chunks.orderBy(F.rand(3)), str(tmp_path / "chunks"))
    got = warc.read_chunks(spark, folder, data=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    given = [(r["page_id"], r["html"]) for r in whole.collect() if r["page_id"] is not None]
    assert rows(got) == sorted(expected_records(given), key=repr) and index.count() == len(given)
    again, _ = warc.archive_chunks(
        warc.read_chunks(spark, folder).where("record_type = 'response'").withColumn("url", F.lit("u")), str(tmp_path / "again")
    )
    assert {r["record_type"] for r in warc.read_index(spark, again).collect()} == {"response"}


def test_a_changed_archive_is_noticed(spark, pages, tmp_path):
    folder, index = warc.write_archives(pages.where("page_id = 10"), str(tmp_path / "a"))
    name = index.first()["archive"]
    path = os.path.join(folder, name)
    record = gzip.decompress(open(path, "rb").read())
    assert list(warc.read_records(gzip.GzipFile(path), name))[-1][-1]
    with open(tmp_path / "b", "wb") as file:
        file.write(gzip.compress(record[:-10] + b"x" + record[-9:]))
    with pytest.raises(ValueError):
        list(warc.read_records(gzip.GzipFile(tmp_path / "b"), name))


def test_no_pages(spark, pages):
    assert warc.archived_pages(pages.where("false")).count() == 0


# Conversations ------------------------------------------------------------------------

GRAMMAR = re.compile("(s?(ua)+)?")
TALK = "conv_id long, turn long, role string, text string, n int, fault string"


def brute_repair(turns):
    """Dijkstra over what is done and the output so far, straight from the contract."""
    seen, faults = set(), []
    for _, role, text in turns:
        visible = re.sub(r"[\x20\x09-\x0D]+", "", text)
        fault = "B" if not visible else "D" if (role, text) in seen else "" if visible[-1] in ".!?" else "T"
        seen.add((role, text))
        faults.append(fault)
    counts = tuple(faults.count(k) for k in "BDT")
    initials = [role[:1] for _, role, _ in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    best = {"": (0, "", ())}  # by output initials
    for (_, role, text), fault in zip(turns, faults):
        best = grown(best)
        new = {}

        def offer(shape, value):
            if viable(shape) and (shape not in new or value < new[shape]):
                new[shape] = value

        for shape, (cost, audit, out) in best.items():
            offer(shape, (cost + 4, audit + "D", out))
            if fault in ("", "T"):
                more = 3 * (fault == "T")
                if role:  # an empty role is none of the grammar's
                    offer(shape + role[:1], (cost + more, audit + "K", (*out, f"{role}:{text}")))
                for other in ("user", "assistant"):
                    offer(shape + other[0], (cost + 3 + more, audit + "R", (*out, f"{other}:{text}")))
        best = new
    cost, audit, out = min(v for k, v in grown(best).items() if GRAMMAR.fullmatch(k))
    hashed = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return (gaps, *counts, illegal, cost, audit, hashed)


def viable(shape):
    return re.fullmatch("s?(ua)*u?", shape)


def grown(best):
    """With up to two insertions at the end."""
    for _ in range(2):
        more = dict(best)
        for shape, (cost, audit, out) in best.items():
            for role in ("user", "assistant"):
                value, key = (cost + 3, audit + "I", (*out, f"{role}:")), shape + role[0]
                if viable(key) and (key not in more or value < more[key]):
                    more[key] = value
        best = more
    return best


@pytest.fixture(scope="module")
def talks(spark):
    rng = np.random.default_rng(3)
    roles = ["user", "assistant", "system", "tool", "", None, "u"]
    texts = ["a.", "b!", "c?  ", "open", "", " \t\n", None, "é. ", "x\x0b"]
    rows = []
    for conv in range(120):
        size = 1 + int(rng.integers(8))
        for turn in range(size):
            role = roles[int(rng.choice(7, p=[0.35, 0.3, 0.1, 0.08, 0.05, 0.05, 0.07]))]
            text = texts[int(rng.choice(9, p=[0.2, 0.15, 0.15, 0.15, 0.05, 0.05, 0.05, 0.1, 0.1]))]
            number = None if rng.random() < 0.1 else int(turn + rng.integers(3))
            row = (None if conv == 7 else conv, number, role, text, 5, "x")
            rows += [row] * (1 + int(rng.random() < 0.1))
    long = [(500, k, "user" if k % 3 else "assistant", f"t{k}." if k % 7 else "cut", 5, "x") for k in range(3000)]
    return rows + long


def in_order(rows):
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x, *_ in rows]
    plain.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
    out = {}
    for conv, *row in plain:
        out.setdefault(conv, []).append(tuple(row))
    return out


@pytest.mark.parametrize("partitions", [1, 13])
def test_repairs_are_the_cheapest(spark, talks, partitions):
    """Also where a conversation is cut by the range partitioning."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        frame = spark.createDataFrame(talks, TALK).repartition(5)
        reports, turns, hashes = conversations.repair_conversations(frame)
        digest = {r["conv_id"]: r["repaired_sha256"] for r in hashes.collect()}
        got = {r["conv_id"]: (*tuple(r)[1:], digest[r["conv_id"]]) for r in reports.collect()}
        repaired = turns.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    given = in_order(talks)
    assert set(got) == set(given)
    for conv, rows in given.items():
        if conv != 500:
            assert got[conv] == brute_repair(rows), (conv, rows)
    wide = [r for r in repaired if r["conv_id"] == 500]
    assert len(got[500][6]) >= 3000 and got[500][6].count("I") + 3000 == len(got[500][6])
    shape = "".join(r["role"][0] for r in sorted(wide, key=lambda r: r["position"]))
    assert GRAMMAR.fullmatch(shape)
    for conv, parts in itertools.groupby(
        sorted(repaired, key=lambda r: (r["conv_id"] is None, r["conv_id"] or 0, r["position"])), lambda r: r["conv_id"]
    ):
        said = "\n".join(f"{r['role']}:{r['text']}" for r in parts)
        assert hashlib.sha256(said.encode()).hexdigest() == digest[conv]


def test_long_conversation_alone_and_cut_agree(spark, talks):
    """One stream through all rows gives what the chained parts give."""
    rows = in_order([r for r in talks if r[0] == 500])[500]
    segment = conversations._Segment(500, continued=False)
    seen = set()
    for turn, role, text in rows:
        duplicate = (role, text) in seen
        seen.add((role, text))
        kind = conversations.DUPLICATE if duplicate else conversations.OK if text[-1] in ".!?" else conversations.TRUNCATED
        segment.take(turn, role[:1], 1, kind)
    chain = conversations._Chain(500)
    chain.add(*segment.row(0)[2:])
    reports, _, _ = conversations.repair_conversations(spark.createDataFrame([r for r in talks if r[0] == 500], TALK))
    assert tuple(reports.first()) == chain.row()


def test_no_conversations(spark, talks):
    reports, turns, hashes = conversations.repair_conversations(spark.createDataFrame([], TALK))
    assert reports.count() == turns.count() == hashes.count() == 0


# Whitening ----------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["spread", "clustered", "flat", "rank", "tiny", "one", "two"])
def test_spectrum(kind):
    rng = np.random.default_rng(1)
    d = {"one": 1, "two": 2}.get(kind, 40)
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = {
        "spread": 10.0 ** -np.linspace(0, 9, d), "clustered": np.repeat([5.0, 1.0 + 1e-9, 1.0, 0.5], 10)[:d],
        "flat": np.ones(d), "rank": np.r_[np.arange(1.0, 11), np.zeros(30)], "tiny": 1e-200 * np.arange(1.0, d + 1),
        "one": np.array([3.0]), "two": np.array([2.0, 1.0]),
    }[kind]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    got, basis = whitening.spectrum(a)
    exact = np.linalg.eigvalsh(a)[::-1]
    scale = np.abs(exact).max()
    assert np.allclose(got, exact, atol=1e-13 * scale, rtol=0)
    assert np.allclose(basis.T @ basis, np.eye(d), atol=1e-13)
    assert np.allclose(a @ basis, basis * got, atol=3e-14 * scale)


def brute_whitening(rows):
    x = {i: np.floor(64 * np.array(v, np.float64)).astype(object) + 1_000_000 for i, v in rows}
    fit = np.array(list(dict.fromkeys(tuple(v) for v in x.values())), object)
    n, sums = len(fit), fit.sum(axis=0)
    near = np.array([[float(int(n * v - s)) / n for v, s in zip(row, sums)] for row in fit])
    covariance = near.T @ near / n
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1], basis[:, ::-1]
    out = {}
    for i, v in x.items():
        apart = [int(n * a - s) for a, s in zip(v, sums)]
        white = np.array([a / n for a in apart]) @ basis / np.sqrt(np.abs(values))
        out[i] = (n, sum(a * a for a in apart), white, values / np.trace(covariance))
    return out


def test_whitening(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    given = [(r["vec_id"], r["embedding"]) for r in rows]
    extra = [(10_000 + i, v) for i, v in given[:5]] + [(20_000, None), (20_001, [1.0, None]), (20_002, [float("nan")] * 64), (20_003, [])]
    frame = spark.createDataFrame(
        [(i, v, "x", 1) for i, v in given + extra], "vec_id long, embedding array<float>, component string, n int"
    ).repartition(5)
    expected = brute_whitening(given + extra[:5])
    got = whitening.whiten(frame).collect()
    assert len(got) == 16 * len(expected)
    signs = {}
    for r in got:
        n, deviation, white, explained = expected[r["vec_id"]]
        k = r["component"] - 1
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert r["explained"] == pytest.approx(explained[k], rel=1e-9) and r["identity_error"] < 1e-9
        sign = signs.setdefault(k, 1 if r["whitened"] * white[k] > 0 else -1) if abs(white[k]) > 1e-6 else signs.get(k, 1)
        assert r["whitened"] == pytest.approx(sign * white[k], abs=1e-8)


def test_odd_vectors(spark):
    big = 2.0**45
    rows = [(1, [big, 1.0]), (2, [-big, 2.0]), (2, [-big, 2.0]), (None, [0.0, 3.0]), (3, [1e300, 1.0]), (4, [1.0, 2.0, 3.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    pairs = [r for r in got if r["vec_id"] != 4]
    assert sorted(str(r["vec_id"]) for r in pairs) == ["1", "1", "2", "2", "2", "2", "None", "None"]
    assert {r["n"] for r in pairs} == {3} and {r["deviation"] for r in pairs if r["vec_id"] == 1} == {None}
    alone = [r for r in got if r["vec_id"] == 4]
    assert [(r["component"], r["whitened"], r["deviation"]) for r in alone] == [(1, None, 0), (2, None, 0), (3, None, 0)]
    assert whitening.whiten(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_whitening_query_is_white(spark):
    out = QUERIES["op13_whitening"](spark, SMALL)
    fit = out.where("component <= 16")
    assert fit.agg(F.max("identity_error")).first()[0] < 1e-4
    assert fit.select("vec_id").distinct().count() == spark.read.parquet(f"{SMALL}/embeddings.parquet").count()
