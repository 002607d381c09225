"""Source divergence, fill-in-middle and language ID against brute force, round trips and held-out accuracy."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strikelake import llm
from strikelake.llm import divergence, fim, langid

from .test_operators import make, prose, same

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SCHEMA = "doc_id long, text string, lang string, source string"
CLASH = ["n", "term", "part", "p", "q", "form", "output", "letters", "h1", "lang_pred", "score", "kept", "_id", "_lang",
         "row", "x", "shard", "value", "rank"]
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for i in range(160):
        lang = [None, "", "en", "é", "en"][i % 5]
        out.append((i, prose(rng, rng.choice([0, 1, 3, 20, 60])), lang, rng.choice(["hot", "hot", "hot", "b", None, "", "ü"])))
    out += [(900, "alpha " * 4000, "en", "hot"), (901, None, "en", "new"), (902, "ZZ zz Zz", "solo", "x"), (902, "ZZ", "solo", "x"),
            (None, "bravo", "en", None), (903, "\x00\x01 12 ,", "xx", "q"), (904, "ÀÀ àà àÀ é̂", "en", "b")]
    return out + [out[5], out[5]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in CLASH}).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# --- divergence


def audit_by_hand(rows, min_docs, top):
    counts, docs, groups = Counter(), Counter(), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        docs.update({(lang, t) for t in terms})
        counts.update((lang, source, t) for t in terms)
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (x, t), n in docs.items() if x == lang and n >= min_docs)
        sources = sorted(s for x, s in groups if x == lang)
        share = lambda n, total: 1 + 10**9 * (n + 5) // (total + 5 * len(kept))
        count = {s: {t: counts[lang, s, t] for t in kept} for s in sources}
        p = {s: {t: share(n, sum(count[s].values())) for t, n in count[s].items()} for s in sources}
        every = {t: sum(count[s][t] for s in sources) for t in kept}
        q = {t: share(n, sum(every.values())) for t, n in every.items()}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -v, i) for i, (v, _, item) in enumerate(items, 1)]
    return out


@pytest.mark.parametrize("min_docs,top", [(30, 50), (3, 4), (1, 50), (10_000, 50)])
def test_audit_equals_brute_force(docs, rows, min_docs, top):
    same(divergence.audit(docs, min_docs, top), audit_by_hand(rows, min_docs, top))


@pytest.mark.parametrize("shard,block", [(3, 2), (1, 1), (1000, 3)])
def test_shards_and_blocks_add_up(docs, rows, shard, block):
    groups, terms = divergence.rated(docs, 3)
    got = divergence.pair_distances(groups, terms, shard, block)
    same(got, [(r[0], r[1], r[3], r[4]) for r in audit_by_hand(rows, 3, 50) if r[2] == "pair"])


@pytest.mark.parametrize("piece,held", [(1, 1), (64, 10), (1 << 22, 400_000)])
def test_partial_counts_are_bounded_and_add_up(docs, rows, piece, held):
    parts = divergence.partial_counts(docs, piece, held)
    got = parts.filter("term != ''").groupBy("lang", "source", "term").agg(F.sum("n"), F.sum("docs"))
    want, docs_with = Counter(), Counter()
    for _, text, lang, source in rows:
        terms = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        want.update((lang or "", source or "", t) for t in terms)
        docs_with.update({(lang or "", source or "", t) for t in terms})
    same(got, [(*k, n, docs_with[k]) for k, n in want.items()])


def test_no_documents_no_divergence(none):
    assert divergence.audit(none).count() == 0


def test_shares_stay_exact_for_counts_beyond_a_long_product(spark):
    big = 9 * 10**17
    row = spark.range(1).select(divergence.share(F.lit(big), F.lit(big + 7), F.lit(1000)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (big + 5) // (big + 7 + 5000)


# --- fill in the middle


def fim_by_hand(doc_id, text):
    text = text or ""
    h = hashlib.sha256(b"1:" + ("" if doc_id is None else str(doc_id)).encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    lo, hi = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    p, m, s = text[:lo], text[lo:hi], text[hi:]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, len(text), "plain", None, None, text, text)
    if h4 % 100 < 20:
        return (doc_id, len(text), "spm", lo, hi - lo, f"<S>{s}<P>{p}<M>{m}", text)
    return (doc_id, len(text), "psm", lo, hi - lo, f"<P>{p}<S>{s}<M>{m}", text)


def hard_texts():
    rng = random.Random(11)
    shared = prose(rng, 900)
    texts = ["", None, "a", "é", "日本語" * 2000, "x" * 70000, "ab" * 40000, shared, shared + " more", "lead " + shared,
             shared[:3000] + "<P>" + shared, "<M>", "<", "<S", "<S<P<M", "S><P", "<S>" * 5, "<<P>", "\U0001F600" * 3000,
             "a" * 8190 + "<S>" + "b" * 9000, "a" * 8191 + "<S>", "a" * 8192 + "<S>", "é" * 4095 + "a<M>", "\x00" * 500]
    return texts + [prose(rng, rng.randint(1, 500)) for _ in range(150)] + ["<P" + prose(rng, 40) + "S>"] * 3


def test_forms_equal_brute_force_and_come_back(spark):
    rows = [(i, t, "en", "a") for i, t in enumerate(hard_texts())]
    rows += [(5, "other text of id 5", "en", "a"), (None, "no id", None, None), rows[7]]
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in CLASH}).repartition(4)
    got = fim.fill_in_middle(table).withColumn("back", fim.restored())
    same(got.drop("n_chunks"), [fim_by_hand(r[0], r[1]) for r in rows])
    assert {r["form"] for r in got.select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_other_rates(spark):
    table = spark.createDataFrame([(i, "some text", "en", "a") for i in range(200)], SCHEMA)
    assert fim.fill_in_middle(table, rate=0).filter("form != 'plain'").count() == 0
    assert fim.fill_in_middle(table, rate=100, spm=100).filter("form != 'spm'").count() == 0
    assert fim.fill_in_middle(table, seed="2").select("prefix_chars").distinct().count() > 3


def test_no_documents_no_forms(none):
    assert fim.fill_in_middle(none).count() == 0


def test_chunks_cover_texts_and_are_shared():
    rng = random.Random(2)
    passage = prose(rng, 4000)
    texts = [t or "" for t in hard_texts()] + [prose(rng, 50) + passage, prose(rng, 77) + passage]
    column, memo = pa.array(texts), fim.Memo()
    for row, c in fim.chunked(column, memo):
        raw = texts[row].encode()
        assert c.n == len(texts[row]) and (c.ends[-1] - c.start if c.ends else 0) == len(raw)
        assert c.marked == any(s in texts[row] for s in ("<P>", "<S>", "<M>"))
        assert all(0 < e - s <= fim.MOST for s, e in zip([c.start, *c.ends], c.ends))
        for k in {0, c.n // 3, c.n // 2, c.n}:
            assert c.offset(k) - c.start == len(texts[row][:k].encode())
    before = memo.misses
    list(fim.chunked(pa.array([prose(rng, 31) + passage]), memo))
    assert memo.misses - before <= 4 < memo.hits  # only what is new is summarized


def test_memo_checks_content_and_is_bounded():
    memo = fim.Memo(room=100)
    assert memo.summary(1, b"abc") == (3, False)
    assert memo.summary(1, "é<P>".encode()) == (4, True)  # another chunk of the same fingerprint
    assert memo.summary(1, b"abc") == (3, False) and memo.hits == 1
    for i in range(50):
        memo.summary(i + 10, bytes([65 + i % 20]) * 9)
    assert memo.held <= 100 and memo.held == sum(len(c) for c, _ in memo.known.values())


# --- language ID

SYLLABLES = {"en": ["the", "ing", "tion", "er", "and", "sh", "wh"], "fr": ["eau", "oi", "ment", "é", "que", "aux"],
             "日": ["日", "本", "語", "の", "は", "学"]}


def babble(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_languages_are_learned_and_everything_is_predicted(spark, none):
    rng = random.Random(5)
    rows = [(i, babble(rng, lang, rng.choice([1, 4, 30, 400])), lang, "a")
            for i in range(600) for lang in [["en", "en", "en", "en", "fr", "日"][i % 6]]]
    odd = [(1000, None, "en", "a"), (1001, "", "en", "a"), (1002, " 12 \n!", "en", "a"), (1003, "é", None, None),
           (None, "the and", "en", "a"), (1004, "the " * 100_000, "en", "a"), (1005, "ÿ", "fr", "a"), rows[3], rows[3]]
    table = spark.createDataFrame(rows + odd, SCHEMA).withColumns({c: F.lit("x") for c in CLASH if c != "lang"})
    model = langid.train(table)
    got = langid.identified(table, model).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows + odd)
    truth = {r[0]: r[2] for r in rows}
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held) > 50
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (1000, 1001, 1002))
    assert all(by_id[i]["lang_pred"] in SYLLABLES for i in (1003, None, 1004, 1005))
    assert by_id[1004]["lang_pred"] == "en" and all(0 <= r["score"] <= 1 for r in got)
    again = langid.identified(table.repartition(7), langid.train(table.repartition(3))).collect()
    assert Counter((r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in again) == Counter(
        (r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in got)
    # held-out languages are not learned: shuffling them changes nothing
    lied = table.withColumn("lang", F.when(langid.fold(F.col("doc_id")) == 2, F.lit("zz")).otherwise(F.col("lang")))
    assert langid.train(lied).langs == model.langs
    assert langid.identified(none, model).count() == 0


def test_few_or_no_languages(spark, none):
    table = spark.createDataFrame([(i, "ab cd", "en", "a") for i in range(9)], SCHEMA)
    assert {r["lang_pred"] for r in langid.identified(table, langid.train(table)).collect()} == {"en"}
    assert {(r["lang_pred"], r["score"]) for r in langid.identified(table, langid.train(none)).collect()} == {("und", 0.0)}
    assert langid.sampled(table, per_lang=3) == langid.sampled(table, size=3)[:3]


def test_sample_is_bounded(spark):
    table = spark.createDataFrame(
        [(i, "x" * (i + 1), ["a", "b", "c"][i % 3], "s") for i in range(300)] + [(5, "second text", "c", "s")], SCHEMA)
    got = langid.sampled(table, per_lang=10, size=24, max_bytes=250)
    assert len(got) == 24 and Counter(lang for lang, _ in got) == {"a": 8, "b": 8, "c": 8}
    assert all(len(t) <= 250 for _, t in got)


def test_kernel_is_the_blended_spectrum_of_distinct_grams():
    texts = [b"Abc abc", "é1x".encode(), b"bc", b"", b"abcabc" * 50]
    sets = []
    for t in texts:
        folded = bytes(langid._FOLD[np.frombuffer(t, np.uint8)])
        sets.append({(n, folded[i : i + n]) for n in langid.ORDERS for i in range(len(folded) - n + 1)})
    landmarks = [0, 1]
    seen = [langid.distinct(np.frombuffer(texts[i], np.uint8)) for i in landmarks]
    vocabulary = langid.Vocabulary([np.unique(np.concatenate([s[i] for s in seen]), return_counts=True) for i in range(4)])
    held = sets[0] | sets[1]
    assert vocabulary.size == len(held)
    got = vocabulary.presence(np.frombuffer(b"".join(texts), np.uint8), np.r_[0, np.cumsum([len(t) for t in texts])])
    near = langid.kernel(got, got[landmarks])
    for i, a in enumerate(sets):
        for j in landmarks:
            want = len(a & sets[j] & held) / np.sqrt(max(len(a & held), 1) * len(sets[j]))
            assert abs(near[i, j] - want) < 1e-9


def test_long_texts_are_read_whole(monkeypatch):
    data = np.frombuffer(("x" * 5000 + " the end").encode(), np.uint8)
    vocabulary = langid.Vocabulary([(u, np.ones(len(u))) for u in langid.distinct(data)])
    whole = vocabulary.presence(data, np.array([0, len(data)]))
    monkeypatch.setattr(langid, "STRIDE", 7)
    assert (vocabulary.presence(data, np.array([0, len(data)])) == whole).all() and whole.all()


def test_language_held_out_accuracy(spark):
    if not os.path.exists(f"{SF}/documents.parquet"):
        pytest.skip("no test tables")
    got = llm.QUERIES["op13_kernel_langid"](spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.99 * len(got) > 100
