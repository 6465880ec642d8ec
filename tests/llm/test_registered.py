"""The registered queries and the pipeline's stages against brute force on the smallest tables."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from airlake.llm import language, minhash, mixing, secrets
from airlake.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.test_operators import WORD, brute_links, linked, removed


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def columns(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op1(spark, pairs):
    got = QUERIES["op1_substring_dedup"](spark, SMALL)
    assert columns(got, "doc_id", "n_words", "n_removed", "kept_sha256") == removed(pairs)


def test_op2_and_op9(spark, pairs):
    word, byte = (Tokenizer.from_file(public_tokenizers.path(n)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
    expected, counts = [], []
    for i, text in pairs:
        ids = word.encode(text or "", add_special_tokens=False).ids
        packed = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        expected.append((i, len(ids), packed, sha(word.decode(ids, skip_special_tokens=False))))
        n = len(byte.encode(text or "", add_special_tokens=False))
        counts.append((i, len((text or "").encode()), n, n > 1024))
    got = QUERIES["op2_bpe"](spark, SMALL)
    assert columns(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=repr)
    got = QUERIES["op9_token_counts"](spark, SMALL)
    assert columns(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(counts, key=repr)


def test_op4(spark, pairs):
    expected = []
    for i, text in pairs:
        text = text or ""
        words, seen, dup = WORD.findall(text), set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        uses = collections.Counter(zip(words, words[1:], words[2:]))
        again = {j + k for j in range(len(words) - 2) for k in range(3) if uses[tuple(words[j : j + 3])] > 1}
        failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
        symbols = sum(c in "#*$%&|<>" for c in text)
        expected.append((i, len(words), sum(map(len, words)), symbols, dup, len(again), failed))
    got = QUERIES["op4_quality"](spark, SMALL)
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert columns(got, *names) == sorted(expected, key=repr)
    assert got.where("base_failed and kept").count() == 0


def test_op6(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    expected = sorted(((i, *v) for (i, _), v in brute_links(rows).items()), key=repr)
    assert columns(QUERIES["op6_embeddings"](spark, SMALL), "vec_id", "n_links", "component_id", "kept") == expected


def test_op7(spark, pairs):
    got = QUERIES["op7_minhash"](spark, SMALL)
    assert columns(got, "doc_id", "n_shingles", "component_id", "kept") == linked(pairs, 4)


def test_op8(spark, pairs):
    lower, counts = str.maketrans(minhash.UPPER, minhash.LOWER), collections.Counter()
    tokens = {i: [*WORD.findall((t or "").translate(lower)), "\n"] for i, t in pairs}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    for i, own in tokens.items():
        if not held[i]:
            counts.update(own)
    n, size = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    expected = [
        (i, held[i], len(own), sum(counts[w] > 0 for w in own), n, round(sum(math.log10((counts[w] + 0.5) / size) for w in own), 5))
        for i, own in tokens.items()
    ]
    got = QUERIES["op8_lm_scoring"](spark, SMALL).withColumn("base_score", F.round("base_score", 5))
    assert columns(got, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score") == sorted(expected, key=repr)


# Secrets, straight from the contract ---------------------------------------------------

ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def test_op10(spark, pairs):
    got = {r["doc_id"]: r for r in QUERIES["op10_secrets"](spark, SMALL).collect()}
    assert len(got) == len(pairs)
    for i, text in pairs:
        base, row = base_spans(text or ""), got[i]
        kinds = [k for k, _, _ in base]
        assert [row[f"n_{k}"] for k in ("assign", "access", "hex")] == [kinds.count(k) for k in ("assign", "access", "hex")]
        assert row["base_sha256"] == sha(joined(base))
        own = [s for s in row["spans"].split(",") if s and s.split(":")[0] in ("assign", "access", "hex")]
        assert ",".join(own) == joined(base)


def test_base_spans_of_random_strings():
    rng = np.random.default_rng(9)
    parts = ["password", "API_KEY", "token", "secret", '"', "'", " ", ":", "=", "AKIA", "AKIA" + "B2" * 9, "a1b2c3d4", "0f" * 12, "x", "\n", "é", "-", "K9", "deadbeef"]
    for _ in range(3000):
        text = "".join(rng.choice(parts, rng.integers(1, 16)))
        found = [(secrets.KINDS[k], s, e) for k, s, e in secrets.find_secrets(text) if k < 3]
        assert found == base_spans(text)


def test_long_runs_are_scanned_once():
    """Time in proportion to the text, also where every place looks like the beginning of a token."""
    import time

    for unit in ("eyJ-", "eyJabc", "password ", "ghp_", "xoxb-", "AKIA", "-----BEGIN RSA PRIVATE KEY-----\n", "0a"):
        started = time.perf_counter()
        secrets.find_secrets(unit * (400_000 // len(unit)))
        assert time.perf_counter() - started < 4, unit
    token = "eyJ" + "a" * 20 + ".eyJ" + "b" * 20 + "." + "c" * 20
    assert [(secrets.KINDS[k], s, e) for k, s, e in secrets.find_secrets(f"x {token} y")] == [("web_token", 2, 2 + len(token))]


# Language models -----------------------------------------------------------------------


def kneser_ney(texts, order=4, discount=0.75):
    """P(character | context) by interpolated Kneser-Ney, from dictionaries of strings."""
    counts = [collections.Counter() for _ in range(order + 1)]
    for text in texts:
        s = text
        for n in range(1, order + 1):
            for i in range(max(n - 1, 1), len(s)):
                counts[n][s[i - n + 1 : i + 1]] += 1
    return counts, discount, order


def normal(text):
    return re.sub(" +", " ", " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " ")


def probability(models, alphabet, lang, window):
    """Of the window's last character after the others, in one language."""
    counts, discount, order = models[lang]
    n = len(window)
    if n == 0:
        return 1.0 / alphabet
    below = probability(models, alphabet, lang, window[1:])
    uses = models["uses"][lang][n]
    total, kinds = models["contexts"][lang][n].get(window[:-1], (0, 0))
    if not total:
        return below
    return max(uses.get(window, 0) - discount, 0) / total + discount * kinds / total * below


def test_op5_equals_plain_kneser_ney(spark, docs):
    learnable = docs.where(language.learnable(F.col("doc_id"), F.col("lang")))
    model = language.fit_languages(learnable)
    labelled = learnable.select("doc_id", "lang", "text").where("text is not null")
    learned = collections.defaultdict(list)
    for r in language._samples(labelled)[0].collect():
        learned[r["lang"]].append(normal(r["text"]))
    assert set(model.langs) == set(learned)
    models = {lang: kneser_ney(texts) for lang, texts in learned.items()}
    grams = [set().union(*(models[lang][0][n] for lang in learned)) for n in range(5)]
    uses, contexts = {}, {}
    for lang in learned:
        counts = models[lang][0]
        own = [None] + [collections.Counter() for _ in range(4)]
        own[4] = counts[4]
        for n in range(1, 4):
            for longer in counts[n + 1]:
                own[n][longer[1:]] += 1
            later = {longer[1:] for longer in grams[n + 1]}
            for g in grams[n] - later:  # nothing stands before it in any language
                own[n][g] = int(counts[n][g] > 0)
        uses[lang] = own
        tables = [None]
        for n in range(1, 5):
            table = {}
            for g, c in own[n].items():
                if c > 0:
                    total, kinds = table.get(g[:-1], (0, 0))
                    table[g[:-1]] = (total + c, kinds + 1)
            tables.append(table)
        contexts[lang] = tables
    models |= {"uses": uses, "contexts": contexts}
    alphabet = len(grams[1]) + 1
    got = {r["doc_id"]: r for r in QUERIES["op5_language"](spark, SMALL).collect()}
    checked = 0
    for r in docs.collect():
        row = got[r["doc_id"]]
        assert row["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= row["score"] <= 1
        text = normal(r["text"] or "")
        if not text.strip():
            assert row["lang_pred"] == "und"
            continue
        if len(text) > 1500:
            continue
        entropy = {}
        for lang in learned:
            bits = [-math.log2(probability(models, alphabet, lang, text[max(0, i - 3) : i + 1])) for i in range(1, len(text))]
            entropy[lang] = sum(bits) / len(bits)
        best = min(entropy, key=entropy.get)
        assert row["cross_entropy"] == pytest.approx(entropy[best], abs=2e-4)
        if sorted(entropy.values())[1] - entropy[best] > 1e-3:
            assert row["lang_pred"] == best
        checked += 1
    assert checked > 50
    held = [r for r in docs.collect() if r["lang"] and got[r["doc_id"]]["held_out"] and got[r["doc_id"]]["lang_pred"] != "und"]
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) > 0.95


# The pipeline, stage by stage ------------------------------------------------------------


def poisson_count(rate, u):
    p = c = math.exp(-rate)
    k = 0
    while c <= u:
        k += 1
        p *= rate / k
        c += p
    return k


def test_pipeline_stages(spark, docs):
    import corpus_pipeline

    names = docs.columns

    def run(stage, frame):
        out = dict(corpus_pipeline.STAGES)[stage](spark, frame, SMALL)
        path = corpus_pipeline.scratch(spark, "test")
        out.write.parquet(path)
        return spark.read.parquet(path)

    # 1. Language: what the model of these rows accepts, untouched.
    first = run("language", docs)
    model = language.fit_languages(docs)
    accepted = {r["doc_id"] for r in language.predict_languages(docs, model).collect() if r["accepted"]}
    assert columns(first, *names) == columns(docs.where(F.col("doc_id").isin(*accepted)), *names)
    clean = docs.where("lang is not null and length(text) > 200")
    assert clean.where(F.col("doc_id").isin(*accepted)).count() >= 0.97 * clean.count()
    # 2. Near-duplicates: the smallest id of each group.
    second = run("near_duplicates", first)
    kept = {i for i, _, _, keep in linked([(r["doc_id"], r["text"]) for r in first.collect()], 5) if keep}
    assert columns(second, *names) == columns(first.where(F.col("doc_id").isin(*kept)), *names)
    # 3. Secrets: each run of overlapping spans becomes a mark. Some are added, and then left to the next stages.
    planted = ['password = "abc123DEF" ' + "0af" * 10, "x AKIA" + "A1" * 9 + " token=secret=abcdef123456", "none"]
    values = {"lang": "en", "source": "src0", "n_chars": 1}
    more = [tuple({**values, "doc_id": 10**6 + k, "text": t}[n] for n in names) for k, t in enumerate(planted)]
    second = second.union(spark.createDataFrame(more, second.schema))
    third = run("secrets", second)
    expected = []
    for r in second.collect():
        text, out, at = r["text"], "", 0
        for _, start, end in secrets.find_secrets(text or ""):
            if start >= at:
                out += text[at:start] + "[SECRET]"
            at = max(at, end)
        text = None if text is None else out + text[at:]
        expected.append(tuple({**r.asDict(), "text": text, "n_chars": None if text is None else len(text)}[n] for n in names))
    assert columns(third, *names) == sorted(expected, key=repr)
    assert third.where("text like '%[SECRET]%'").count() > 0
    # 4. Mixing: as many copies as the Poisson quantile of each id's hash.
    fourth = run("mixing", third)
    rows = third.collect()
    size = collections.Counter()
    for r in rows:
        size[r["source"]] += len(r["text"] or "")
    weights, total = sum(math.sqrt(c) for c in size.values()), sum(size.values())
    rate = {s: math.sqrt(c) / weights * total / c if c else 1.0 for s, c in size.items()}
    assert max(rate.values()) <= mixing.MAX_RATE
    expected = []
    for r in rows:
        digest = hashlib.md5(f"mix:{r['doc_id']}".encode()).hexdigest()
        expected += [tuple(r[n] for n in names)] * poisson_count(rate[r["source"]], int(digest[:13], 16) / 2**52)
    assert columns(fourth, *names) == sorted(expected, key=repr) and fourth.columns == names
    # 5. BPE: the library's ids and their decoding.
    fifth = run("bpe", fourth)
    tool = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for r in fourth.collect():
        ids = tool.encode(r["text"] or "", add_special_tokens=False).ids
        expected.append((r["doc_id"], len(ids), bytes(np.array(ids, "<u4").tobytes()), tool.decode(ids, skip_special_tokens=False)))
    got = [(i, n, bytes(b), d) for i, n, b, d in columns(fifth, "doc_id", "n_tokens", "ids", "decoded")]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    whole = [(i, n) for i, n in columns(corpus_pipeline.run(spark, SMALL), "doc_id", "n_tokens")]
    assert {i for i, _ in whole} <= {r["doc_id"] for r in rows} and len(whole) > 0.8 * len(expected)


def test_columns_of_any_name_are_kept(spark):
    """Names that the operators use themselves, or that need quoting, pass through unchanged."""
    names = ["row", "gone", "__gone", "blob", "__blob", "findings", "__findings", "copy", "shuffle_key", "u", "__u", "n", "__n",
             "key", "cdf", "draws", "rate_of", "a.b", "c`d", "__doc_id"]
    phrase = " ".join(f"w{i}" for i in range(60))
    base = [(1, phrase, "s"), (2, phrase, "s"), (3, "token=abcdef12345 " + phrase[:90], "t"), (4, None, None)]
    values = [0.5 + i for i in range(len(names))]
    quoted = ["`" + n.replace("`", "``") + "`" for n in names]
    schema = "doc_id long, text string, source string, " + ", ".join(f"{q} double" for q in quoted)
    frame = spark.createDataFrame([(*r, *values) for r in base], schema)

    def rest(df):
        assert df.columns == frame.columns
        return {tuple(r[3:]) for r in df.collect()}

    clean = secrets.redact_secrets(frame)
    assert rest(clean) == {tuple(values)} and clean.where("text like '[SECRET]%'").count() == 1
    single = minhash.drop_near_duplicates(frame, width=5)
    assert rest(single) == {tuple(values)} and columns(single, "doc_id") == [(1,), (3,), (4,)]
    again = mixing.replicate(frame)
    assert rest(again) <= {tuple(values)} and again.count() > 0


def test_regular_words_do_not_collide(spark):
    """Two words of 2,048 characters, all different place by place, that any polynomial modulo 2**64 takes for equal."""
    from airlake.llm import suffix_tree

    word = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    other = word.translate(str.maketrans("ab", "ba"))
    frame = spark.createDataFrame([(1, word), (2, other), (3, word)], "doc_id long, text string")
    found = columns(minhash.near_duplicates(frame), "doc_id", "component_id")
    assert found == [(1, 1), (2, 2), (3, 1)]
    known = columns(suffix_tree.score_documents(frame, "doc_id = 1"), "doc_id", "n_known")
    assert known == [(1, 2), (2, 1), (3, 2)]


def test_hashed_words_equal_the_contract():
    """Words from the bytes of an Arrow column, also of a slice of it, equal those of the pattern."""
    import pyarrow as pa

    from airlake.llm import suffix_tree

    texts = ["", "a", " a  B\t\ta\x0bé É\x1cx ", "\n", "x" * 300 + " y" + " " * 100 + "Z", "", "A b", "end"]
    column = pa.array(["skipped"] + texts).slice(1)
    hashes, doc = suffix_tree.hashed_words(column)
    lower = str.maketrans(minhash.UPPER, minhash.LOWER)
    expected = [(i, w) for i, t in enumerate(texts) for w in WORD.findall(t.translate(lower))]
    assert doc.tolist() == [i for i, _ in expected]
    names = {}
    for (_, word), h in zip(expected, hashes.tolist()):
        assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)
    assert [len(x) for x in suffix_tree.hashed_words(pa.array([], pa.string()))] == [0, 0]
