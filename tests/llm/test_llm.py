"""Operators of the llm subpackage against brute force, round trips and held-out labels, and their edge cases."""

import collections
import hashlib
import os
import re
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import check_oracle  # noqa: E402

from edilake.llm import bpe, contamination, language, licenses, minhash, ngrams, quality, secrets, substrings, tokens, urls  # noqa: E402
from edilake.llm.components import components  # noqa: E402
from edilake.llm.queries import QUERIES, tokenizer_path  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, score string, label string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({65 + i: 97 + i for i in range(26)}))


def rows_of(texts):
    return [(i, t, "en", None, None, "k", "s", "l") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and blank texts, one very long text, ties, repeated rows, clashing columns."""
    long_ = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = rows_of(["a b c d e f g h i j k l", "a b c d e f g h i j k l", "", " \n\t", "x", "Ünï €uro token = \"a1B2c3D4e5F6g7H8i9\" end", long_])
    rows += [rows[0], (None, "a b c d e f g h i j k l", None, None, None, None, None, None), (99, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_sql(spark, name):
    fn, sql = QUERIES[name]
    got, got_columns, want, want_columns = check_oracle.compare(spark, check_oracle.connect(SF), SF, fn, sql)
    assert got_columns == want_columns and got == want and got


def test_word_hashes_do_not_depend_on_the_batch():
    texts = [b"A b  c", b"", "é ß x".encode(), b"b " * 200_000]
    alone = [tokens.word_hashes([t])[0] for t in texts]
    together, bounds = tokens.word_hashes(texts)
    assert all((together[a:b] == h).all() for a, b, h in zip(bounds[:-1], bounds[1:], alone, strict=True))
    assert [len(h) for h in alone] == [len(words(t.decode())) for t in texts]


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 11), *((20, i) for i in range(21, 80)), *((i, i + 1) for i in range(100, 140))]
    got = collections.defaultdict(set)
    for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect():
        got[r.label].add(r.node)
    assert sorted(map(sorted, got.values())) == [[1, 2, 3], [10, 11], list(range(20, 80)), list(range(100, 141))]


def test_minhash_signature_agrees_as_sets_do():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 1 << 62, 60).astype(np.uint64))
    same = [(minhash.one_permutation(np.sort(tokens.mix(a ^ np.uint64(k))), 160) == minhash.one_permutation(np.sort(tokens.mix(a[:50] ^ np.uint64(k))), 160)).mean()
            for k in range(200)]
    assert abs(np.mean(same) - 50 / 60) < 0.02


def test_near_dedup_edge_cases(odd, empty):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(odd, 3, 85).collect()}
    assert {(0, 10, 0, True), (1, 10, 0, False), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (None, 10, None, False), (99, 0, 99, True)} <= got
    kept = minhash.keep_one(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [0, 2, 3, 4, 5, 6, 99]
    assert minhash.near_duplicates(empty).count() == 0


def test_near_copies_are_linked(spark):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in rng.integers(0, 10**6, 300)]
    texts = []
    for k in range(40):
        copy = list(base)
        for at in rng.choice(300, 4, replace=False):
            copy[at] = f"edit{k}x{at}"
        texts.append(" ".join(copy))
    texts += [" ".join(f"o{k}x{i}" for i in range(200)) for k in range(10)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows_of(texts), DOCS), 3, 85).collect()}
    assert got == {i: 0 if i < 40 else i for i in range(50)}


def family(members, pairs):
    """Texts that take one of two words in 50 of 300 places, most of them below the threshold to each other, and after them
    texts that differ from some of those in six of the places. With the component of each, by all pairs."""
    rng = np.random.default_rng(5)
    taken = rng.integers(0, 2, (members + pairs, 50))
    for k in range(pairs):
        taken[members + k] = taken[100 * k + 50]
        taken[members + k, rng.choice(50, 6, replace=False)] ^= 1
    texts = [" ".join(f"{'ab'[t[i // 6]]}{i}" if i % 6 == 3 else f"w{i}" for i in range(300)) for t in taken]
    component = list(range(len(texts)))
    for j in range(len(texts)):
        changed = 3 * (taken[:j] != taken[j]).sum(axis=1)
        for i in np.flatnonzero(100 * (298 - changed) >= 85 * (298 + changed)):
            low, high = sorted((component[i], component[j]))
            component = [low if c == high else c for c in component]
    return texts, component


@pytest.mark.parametrize("chunk", [minhash.CHUNK, 150])
def test_links_inside_a_large_bucket_of_unlinked_members(spark, monkeypatch, chunk):
    monkeypatch.setattr(minhash.blocks, "__defaults__", (chunk,))
    texts, component = family(2000, 8)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows_of(texts), DOCS), 3, 85).collect()}
    assert len(set(component)) > 1900 and got == dict(enumerate(component))


def test_blocks_let_all_labels_meet(spark):
    rows = [(b, k, k if k > 40 else 0) for b, n in ((1, 5), (2, 90), (3, 45)) for k in range(n)]
    table = spark.createDataFrame(rows, "bucket bigint, key bigint, label bigint")
    met = collections.Counter()
    blocks = collections.defaultdict(list)
    for r in minhash.blocks(table, 10).collect():
        blocks[r.bucket, r.x, r.y].append((r.key, r.label, r.chunk))
    for (b, x, y), members in blocks.items():
        met.update((b, k, m) for k, lk, ck in members for m, lm, cm in members if k < m and lk != lm and (x == y or ck != cm))
    want = {(b, k, m) for b, k, lk in rows for c, m, lm in rows if b == c and k < m and lk != lm}
    assert set(met) == want and max(met.values()) == 1 and max(map(len, blocks.values())) < 60


def test_secrets(spark, odd, empty):
    found = {(r.doc_id, r.start, r.length): r.is_secret for r in secrets.report(odd).collect()}
    assert found == {(5, 18, 18): True}
    clean = secrets.redact(odd)
    assert clean.columns == odd.columns and clean.count() == odd.count()
    assert clean.where("doc_id = 5").first().text == "Ünï €uro token = \"<SECRET>\" end"
    assert secrets.report(empty).count() == 0
    text = "see /usr/lib/x86_64-linux-gnu123 and password: \"q9Zx7Lm2Kp4Rt8Vw\" or 4111111111111111 x"
    got = secrets.report(spark.createDataFrame(rows_of([text] * 30 + ["plain text"]), DOCS)).collect()
    assert all(r.is_secret == (r.length == 16 and text[r.start] == "q") for r in got) and len(got) == 90


def test_dictionary_counts_the_words_of_all_texts_and_copies_once(spark):
    filler = ["hot" + "".join(chr(97 + int(d)) for d in f"{i:03}") for i in range(400)]
    texts = [" ".join(filler[k:] + filler[:k]) for k in range(40) for _ in range(120)] + [f"rare {i}" for i in range(50)] + [None, ""]
    docs = spark.createDataFrame(rows_of(texts), DOCS)
    assert "rare" in secrets.dictionary(docs)
    assert secrets.dictionary(docs, most_words=1) == ["rare"]


def leaked(texts, items, spark, **options):
    docs = spark.createDataFrame(rows_of(texts), DOCS)
    return {(r.doc_id, r.item_id) for r in contamination.leaks(docs, spark.createDataFrame(items, "item_id bigint, text string"), **options).collect()}


def test_decontamination(spark, odd, empty):
    rng = np.random.default_rng(2)
    item = [f"t{i}" for i in rng.integers(0, 10**6, 30)]
    edited = [w if i % 6 else "zz" for i, w in enumerate(item)]
    longer = [x for i, w in enumerate(item) for x in ([w, "um"] if i % 7 == 3 else [w])]
    noise = [f"n{i}" for i in rng.integers(0, 10**6, 200)]
    texts = [" ".join(noise + item + noise), " ".join(noise + edited), " ".join(longer), " ".join(noise), " ".join(item[:8] + noise), None, ""]
    items = [(1, " ".join(item)), (2, "too short"), (3, None), (1, " ".join(item))]
    assert leaked(texts, items, spark) == {(0, 1), (1, 1), (2, 1)}
    assert leaked(texts, items, spark, block_chars=60) == {(0, 1), (1, 1), (2, 1)}
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = spark.createDataFrame(rows_of(texts), DOCS)
    assert sorted(r.doc_id for r in contamination.clean(docs, bench).collect()) == [3, 4, 5, 6]
    assert contamination.leaks(empty, bench).count() == 0 and contamination.leaks(docs, bench.limit(0)).count() == 0
    assert contamination.clean(odd, bench).count() == odd.count()


def test_quality(spark, documents, odd, empty):
    got = quality.judge(documents, spark.read.parquet(f"{SF}/labels.parquet"))
    for r in got.join(documents.select("doc_id", "text"), "doc_id").collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text)
        lines = [x for x in r.text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        seen = collections.defaultdict(list)
        for i in range(len(w) - 4):
            seen[tuple(w[i:i + 5])].append(i)
        repeat = {j for v in seen.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in r.text), len(lines) - len(set(lines)), len(repeat))
        assert not (r.base_failed and r.kept) and r.base_failed == (len(w) < 10 or 100 * len(repeat) > 20 * len(w))
    labels = spark.createDataFrame([(0, None), (None, 1), (77, 0)], "doc_id bigint, quality int")
    assert {(r.doc_id, r.kept) for r in quality.judge(odd, labels).collect() if r.doc_id in (0, 2, 99)} == {(0, True), (2, False), (99, False)}
    assert quality.judge(empty, labels).count() == 0


def test_decision_list_finds_the_rule(spark):
    rng = np.random.default_rng(3)
    x = rng.random((3000, len(quality.FEATURES)))
    bad = (x[:, 2] > 0.8) | ((x[:, 4] > 0.7) & (x[:, 5] < 0.3))
    rows = [(*map(float, v), int(not b), i % 3 > 0) for i, (v, b) in enumerate(zip(x, bad, strict=True))]
    labelled = spark.createDataFrame(rows, [*quality.FEATURES, "label", "grow"]).withColumn("label", F.col("label").cast("int")).cache()
    kept, _ = quality.verdict(quality.learn(labelled))
    right = labelled.where(kept == (F.col("label") == 1)).count()
    assert right > 0.97 * len(rows)


def brute_spans(texts, k):
    count = collections.Counter(t[i:i + k] for t in texts for i in range(len(t) - k + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - k + 1):
            if count[t[i:i + k]] > 1:
                gone[i:i + k] = b"\1" * k
        out.append((len(t), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(bytes(c for c, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [substrings.HOT, 2])
def test_suffix_dedup(spark, hot):
    rng = np.random.default_rng(4)
    passage = "".join(rng.choice(list("abcdefgé "), 300))
    texts = ["".join(rng.choice(list("abcdefgé "), int(n))) for n in rng.integers(0, 900, 30)]
    texts = [t[:len(t) // 2] + passage[int(i) % 40:] + t[len(t) // 2:] if i % 3 else t for i, t in enumerate(texts)]
    texts += [texts[4], "ab" * 400, "", None, passage[:100]]
    got = substrings.remove_repeats(spark.createDataFrame(rows_of(texts), DOCS), 60, 16, hot)
    got = {r.doc_id: (r.n_bytes, r.n_bytes - len(r.rest), len(r.removed), hashlib.sha256(r.rest).hexdigest()) for r in got.collect()}
    assert got == dict(enumerate(brute_spans([(t or "").encode() for t in texts], 60)))


def test_suffix_dedup_edge_cases(odd, empty):
    got = {(r.doc_id, r.n_removed) for r in substrings.digests(odd).collect()}
    assert {(0, 0), (99, 0), (2, 0)} <= got and len(got) == 9 and substrings.digests(empty).count() == 0


def test_deep_shallow_sort():
    rng = np.random.default_rng(5)
    data = bytes(rng.choice(list(b"ab"), 700).tolist())
    order = substrings.deep_shallow_sort(data, np.arange(600), 40)
    assert [data[x[0]:x[0] + 40] for x in order] == sorted({data[i:i + 40] for i in range(600)}) and sorted(sum(order, [])) == list(range(600))


def test_deep_shallow_sort_passes(monkeypatch):
    # many small groups go through a character together, not one by one
    rng, calls = np.random.default_rng(6), []
    lines = [bytes(rng.integers(97, 123, 60).tolist()) for _ in range(300)]
    data = b"".join(lines + lines)
    for name in ("argsort", "lexsort"):
        monkeypatch.setattr(np, name, lambda *a, _of=getattr(np, name), **k: (calls.append(1), _of(*a, **k))[1])
    order = substrings.deep_shallow_sort(data, np.arange(0, len(data), 60), 60)
    assert order == sorted(([i * 60, (i + 300) * 60] for i in range(300)), key=lambda x: data[x[0]:x[0] + 60]) and len(calls) <= 3


def test_shared_values():
    rng = np.random.default_rng(7)
    for n, top in ((0, 9), (1, 9), (500, 1 << 63), (500, 40), (500, 400)):
        values = rng.integers(0, top, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15 if top < 1 << 20 else 1)
        assert substrings._shared(values).tolist() == [c > 1 for c in map(collections.Counter(values.tolist()).get, values.tolist())]


def test_lm(spark, odd, empty):
    docs = spark.createDataFrame(rows_of(["the cat sat", "the cat ran", "a dog ran", "the dog sat", None, ""]), DOCS)
    model = ngrams.build(docs)
    got = {r.text: r for r in ngrams.score(docs.select("text", F.col("text").alias("t")), model).withColumnRenamed("t", "text").collect()}
    c = collections.Counter(w for t in got for w in [*words(t), None])
    assert (model["n"], model["v"]) == (18, 7)
    assert all(r.n_tokens == len(words(t)) + 1 == r.n_known and r.base_score < 0 and r.score < 0 for t, r in got.items()) and c
    # probabilities after a context sum to one over the known words and an unknown one
    vocabulary = ["the", "cat", "sat", "ran", "a", "dog", "nosuch"]
    scorer = ngrams.Model(model)
    for context in ("the", "cat", "nosuch"):
        one = [scorer.score(np.append(tokens.word_hashes([f"{context} {w}".encode()])[0], ngrams.END)[:2], np.array([0, 2]))[3][0] for w in vocabulary]
        end = scorer.score(np.array([tokens.hash_word(context), ngrams.END]), np.array([0, 2]))[3][0]
        first = scorer.score(tokens.word_hashes([context.encode()])[0], np.array([0, 1]))[3][0]
        assert abs(sum(10 ** (x - first) for x in [*one, end]) - 1) < 1e-4
    assert {r.n_tokens for r in ngrams.scores(odd).where("doc_id in (2, 3, 99)").collect()} == {1} and ngrams.scores(empty).count() == 0


def test_lm_base_score(spark, documents):
    rows = documents.select("doc_id", "text").collect()
    c = collections.Counter()
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 7 != 2:
            c.update([*words(r.text), None])
    n, v = sum(c.values()), len(c)
    scored = ngrams.scores(documents)
    for r in scored.join(documents.select("doc_id", "text"), "doc_id").collect():
        own = [*words(r.text), None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(c[w] > 0 for w in own), n)
        assert abs(r.base_score - sum(np.log10((c[w] + 1) / (n + v + 1)) for w in own)) < 1e-6
    held = scored.where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_licenses(spark, odd, empty):
    texts = ["x Released under the MIT License. y", "CC-BY and General Public License; all rights reserved, all RIGHTS reserved", "Released when under the new MIT rules License",
             "the license of the", None, "redistribution and use in source or binary forms with or without modification are permitted provided the following conditions are met"]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows_of(texts), DOCS)).collect()}
    assert [got[i].labels for i in range(6)] == ["mit", "cc-by,gpl,reserved", "mit", "", "", "bsd"]
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels, got[1].score) == (4, 0, 9, "cc-by,gpl,reserved", 1.0)
    assert got[0].first_word is None and got[3].score == 0.0 and got[4].n_words == 0 and 0.8 <= got[5].score < 1
    assert licenses.scan(odd).count() == odd.count() and licenses.scan(empty).count() == 0


def test_license_join_is_exact(spark):
    rng = np.random.default_rng(6)
    pool = sorted({w for _, t in licenses.TEMPLATES for w in t.split()}) + ["other"] * 10
    counts = {int(tokens.hash_word(w)): i % 7 for i, w in enumerate(pool)}
    plan = licenses.Plan(licenses.TEMPLATES, [], counts, 0.6)
    for _ in range(60):
        text = list(rng.choice(pool, 60)) + licenses.TEMPLATES[int(rng.integers(len(licenses.TEMPLATES)))][1].split() + list(rng.choice(pool, 20))
        h = np.array([tokens.hash_word(w) for w in text])
        want = set()
        for i, (_, t) in enumerate(licenses.TEMPLATES):
            own, n = set(t.split()), len(t.split())
            for at in range(0, len(text), n):
                share = len(own & set(text[at:at + 2 * n])) / len(own)
                if share >= 0.6 - 1e-12:
                    want.add((i, at, round(share, 9)))
        assert {(i, at, round(s, 9)) for i, at, s in plan.search(h)} == want


def test_url_cascade(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("h"), F.col("id").cast("string")).alias("host"))
    listed = universe.where("cast(substr(host, 2) as int) % 9 = 0").union(spark.createDataFrame([(None,)], "host string"))
    for shard in (urls.SHARD_KEYS, 900):
        got = urls.Cascade.build(listed, universe, "host", shard).mark(universe.union(spark.createDataFrame([(None,)], "host string")), "host", "in")
        assert got.where("in <> coalesce(cast(substr(host, 2) as int) % 9 = 0, false)").count() == 0 and got.count() == 20_001


def test_url_parts(spark):
    rows = [(1, "http://A.Example.ORG/es/x?y"), (2, "https://b.com"), (3, None), (4, "nothing"), (5, "x://com/de/#z"), (6, "http://adult.net?a/b"), (7, "h://example.org/en/12"), (7, "h://example.org/en/12")]
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge(spark.createDataFrame(rows, "page_id bigint, url string")).orderBy("page_id").collect()]
    assert got == [(1, "a.example.org", "/es/x", "example.org/es/", "block"), (2, "b.com", "", None, "allow"), (3, "", "", None, "allow"), (4, "", "", None, "allow"),
                   (5, "com", "/de/", "com/de/", "block"), (6, "adult.net", "", None, "block"), *[(7, "example.org", "/en/12", "example.org/en/1", "block")] * 2]


def test_bpe(spark, documents, odd, empty):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(tokenizer_path())
    extra = ["<|endoftext|>a<|endoftext|>", "don't I'LL 12¼³", "  x\x1c \x85 \n\n z ", "a" * 20_000]
    docs = documents.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(extra, 10**6)), "doc_id bigint, text string"))
    for r in bpe.decode(bpe.encode(docs, tokenizer_path()), tokenizer_path()).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == reference.encode(r.text, add_special_tokens=False).ids and r.decoded == r.text
    got = {r.doc_id: r.n_tokens for r in bpe.digests(odd, tokenizer_path()).collect()}
    assert got[99] == got[2] == 0 and got[0] == 12 and bpe.digests(empty, tokenizer_path()).count() == 0


def test_language(spark, documents, odd, empty):
    lang = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    held = [r for r in language.languages(documents).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.languages(odd).collect()}
    assert got[99] == got[2] == ("und", 0.0) and got[4][0] == "en"
    assert language.languages(empty).count() == 0 and language.accepted(odd, None).columns == odd.columns


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = corpus_pipeline.run(spark, SF).collect()
    assert 0 < len(got) < docs.count() and all(r.round_trip for r in got) and len({r.doc_id for r in got}) == len(got)
