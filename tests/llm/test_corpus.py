"""The corpus operators against DuckDB, brute force, round trips and odd tables."""

import collections
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.llm import classifier, common, components, exact_dedup, language, minhash, mixing, packing, polyhash, quality, queries, sharding, suffix_dedup, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, kept int, copies int, digest int, shard string, bucket int, anchor string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), "x", 1, 7, 3, "y", 5, "z") for i, t, lang, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank and long texts, ties, repeated rows, columns whose names clash."""
    long = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, " \t\n", None, "a"), (4, long, "en", "a"), (5, long + " tail", "en", None),
        (6, "One two three four five six.", "en", "b"), (6, "One two three four five six.", "en", "b"), (7, "one two three four five six.", "fr", "b"),
        (8, "Onetwo three four five six.", "fr", "é"), (9, "ça été là 😀 naïve", "fr", "é"), (10, "####", "en", None), (11, "a" * 5000, "en", "a"),
        (None, "an id is missing here", "en", "b"), (12, "x", None, "zz"),
    ]
    return table(spark, rows)


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_sql(spark, sf_dir, duck, name):
    assert rows_of(queries.QUERIES[name](spark, sf_dir).toPandas()) == rows_of(duck.execute(queries.ORACLES[name]).df())


def test_sharding(spark, sf_dir, duck, odd, none):
    got = sharding.op3(spark, sf_dir).toPandas()
    assert rows_of(got.drop(columns="text_crc32")) == rows_of(duck.execute(sharding.OP3_SQL).df())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    assert all(r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) for r in got.itertuples())
    out = sharding.shard(odd.select("doc_id", "source", "kept"), 4).toPandas()
    counts = out.groupby("shard").size()
    assert counts.sum() == 14 and counts.max() - counts.min() <= 1 and not out[["shard", "slot"]].duplicated().any()
    assert sharding.shard(none.select("doc_id", "source"), 4).count() == 0


def test_exact_dedup_and_weak_digests(spark, odd, none):
    strong = exact_dedup.exact_dedup(odd)
    weak = exact_dedup.exact_dedup(odd, digest=lambda norm: F.substring(F.unhex(F.md5(norm)), 1, 0))
    assert rows_of(strong.toPandas()) == rows_of(weak.toPandas())  # with one digest for all texts the byte check does all the work
    got = {r.doc_id: r for r in strong.collect()}
    assert got[1].keep_id == got[2].keep_id == got[3].keep_id == 3 and got[1].group_size == 3  # most characters
    assert got[6].keep_id == got[8].keep_id == 6 and got[6].group_size == 3 and got[6].kept and not got[8].kept  # longer original
    assert got[7].keep_id == 7 and got[12].group_size == 1
    assert exact_dedup.exact_dedup(none).count() == 0


def test_exact_dedup_of_repeated_rows_matches_sql(spark, odd):
    con = duckdb.connect()
    frame = odd.unionByName(odd.filter("doc_id is null or doc_id in (4, 12)")).select("doc_id", "text").toPandas().astype({"doc_id": "Int64"})  # noqa: F841
    con.execute("CREATE VIEW documents AS SELECT * FROM frame")
    want = rows_of(con.execute(exact_dedup.OP7_SQL).df())
    docs = odd.unionByName(odd.filter("doc_id is null or doc_id in (4, 12)"))
    assert rows_of(exact_dedup.exact_dedup(docs).toPandas()) == want
    assert rows_of(exact_dedup.exact_dedup(docs, digest=lambda norm: F.substring(F.unhex(F.md5(norm)), 1, 0)).toPandas()) == want


def test_filters_have_no_false_negatives(spark):
    digests = spark.range(2000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    bits = exact_dedup.filter_bits(500)
    maps = exact_dedup.build_filter(digests.limit(500), bits)
    slot = F.pmod(F.xxhash64("digest"), F.lit(bits)) + 1
    hits = digests.withColumn("bucket", F.bitmap_bucket_number(slot)).join(maps, "bucket", "left").select(exact_dedup.passes(F.col("bitmap"), F.col("digest"), bits).alias("hit"))
    assert 500 <= hits.filter("hit").count() < 800


def test_mixing_odd_tables(spark, odd, none):
    got = mixing.mix(odd).toPandas()
    assert len(got) == 14 and (got["taken"] <= 3 * got["size"]).all()
    per = got.drop_duplicates(["source", "target"]).target.sum()
    assert abs(per - got["size"].sum()) < 1e-6 * per
    assert mixing.mix(none).count() == 0
    assert rows_of(got) == rows_of(mixing.mix(odd).toPandas())
    bulk = table(spark, [(i, "w " * (1 + i % 40), "en", f"s{i % 3}") for i in range(3000)])
    mixed = mixing.mix(bulk)
    sums = mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).toPandas()
    assert (abs(sums.taken - sums.target) <= 1).all()
    assert mixing.repeated(bulk, mixed).count() == mixed.agg(F.sum("copies")).first()[0]
    favoured = mixing.mix(bulk.withColumn("f", F.when(F.col("doc_id") % 2 == 0, 9.0).otherwise(1.0)), share=0.3, chance="f").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum("copies").alias("n")).toPandas()
    n = dict(zip(favoured.odd, favoured.n, strict=True))
    assert n[0] > 1.5 * n[1]


@pytest.mark.parametrize("words", [[100] * 6, [100] * 7, [300, 100, 50, 300, 100, 50], [40, 900, 7, 40, 1, 7, 40]])
def test_mixing_sources_of_equal_need(spark, words):
    """Sources three places apart have one weight, so equal sizes tie in capacity per weight; the targets must still add up."""
    docs = table(spark, [(s * 1000 + i, "w", "en", f"s{s}") for s, n in enumerate(words) for i in range(n)])
    con = duckdb.connect()
    frame = docs.select("doc_id", "text", "source").toPandas()  # noqa: F841
    con.execute("CREATE VIEW documents AS SELECT * FROM frame")
    got = mixing.mix(docs)
    assert rows_of(got.select("doc_id", "size", "source_size", "target", "taken").toPandas()) == rows_of(con.execute(mixing.OP10_SQL).df())
    assert abs(got.groupBy("source").agg(F.first("target").alias("t")).agg(F.sum("t")).first()[0] - sum(words)) < 1e-6


def test_mixing_comes_near_small_targets(spark):
    """Whatever the last documents are: a source is off by no more than half of its smallest undrawn document, and by less than a word here, where sizes are many."""
    rng = np.random.default_rng(5)
    sizes = {"giant": [9000, *rng.integers(5, 60, 200)], "even": [30] * 50, "mixed": rng.integers(1, 400, 120).tolist(), "long": rng.integers(800, 900, 40).tolist(), "big": rng.integers(1, 900, 900).tolist()}
    rows = [(f"{s}{i}", int(n), s) for s, many in sizes.items() for i, n in enumerate(many)]
    docs = table(spark, [(i, "w " * n, "en", s) for i, (_, n, s) in enumerate(rows)])
    got = mixing.mix(docs).toPandas()
    for source, part in got.groupby("source"):
        undrawn = part[part.copies == part.copies.min()]["size"]
        off = abs(part.taken.sum() - part.target.iloc[0])
        assert off <= max(1, undrawn.min() / 2), (source, off)
        assert source in ("even", "long") or off <= 1
    con = duckdb.connect()
    frame = docs.select("doc_id", "text", "source").toPandas()  # noqa: F841
    con.execute("CREATE VIEW documents AS SELECT * FROM frame")
    assert rows_of(got[["doc_id", "size", "source_size", "target", "taken"]]) == rows_of(con.execute(mixing.OP10_SQL).df())


def test_mixing_takes_no_extra_copies_of_capped_sources(spark):
    """A source that only takes whole copies takes three of each row, of rows without words too."""
    docs = table(spark, [(0, " ", "en", "s"), (1, None, "en", "s"), (2, "a b", "en", "s"), *[(10 + i, "w " * 50, "en", "t") for i in range(20)]])
    assert {r.copies for r in mixing.mix(docs, weights=(9, 1)).filter("source = 's'").collect()} == {3}


def test_warc_round_trip(spark, none):
    pages = spark.createDataFrame(
        [(1, "http://a/x y\r\nz", "<p>é😀</p>"), (2, None, "<p>é😀</p>"), (3, "http://b", None), (4, "http://c", ""), (5, "http://d", "x" * 300_000), (5, "http://d", "x" * 300_000), (6, "http://e", "\r\n\r\nWARC/1.1\r\n")],
        "page_id long, url string, html string",
    )
    path = common.shared_dir(spark, "test-warc")
    index = warc.write_archives(pages, path)
    got = {r.page_id: r for r in warc.read_archives(index, path).collect()}
    assert got[1].record_type == "revisit" and got[1].refers_to == 2 and got[1].payload_bytes == len("<p>é😀</p>".encode())
    assert bytes(got[2].payload).decode() == "<p>é😀</p>" and got[2].url == "urn:page:2" and got[1].url == "http://a/x%20y%0D%0Az"
    assert got[3].refers_to == 4 and got[4].payload_bytes == 0 and bytes(got[6].payload) == b"\r\n\r\nWARC/1.1\r\n"
    assert index.filter("page_id = 5").count() == 2 and got[5].record_type == "response"
    some = warc.read_archives(index.filter("page_id in (2, 6)"), path).toPandas()
    assert sorted(some.page_id) == [2, 6]
    with pytest.raises(Exception, match="digest|record|header|incorrect"):
        warc.read_archives(index.withColumn("offset", F.col("offset") + 1), path).count() or warc.read_archives(index.withColumn("offset", F.col("offset") + 1), path).collect()
    bigger = warc.read_archives(warc.write_archives(pages, path + "b", min_bytes=5), path + "b").toPandas()
    assert list(bigger[bigger.page_id.isin([3, 4])].record_type) == ["response"] * 2
    empty = warc.write_archives(pages.limit(0), path + "c")
    assert empty.count() == 0 and warc.read_archives(empty, path + "c").count() == 0
    assert list(warc.stretches([(0, 10), (10, 5), (100, 5)], gap=20, most=1000)) == [(0, 2, 0, 15), (2, 3, 100, 105)]


def test_token_ids_are_those_of_the_tokenizers_library(spark, sf_dir):
    import public_tokenizers

    fast = packing.tokenizer(*packing.vocabulary())
    slow = packing.tokenizer(public_tokenizers.path("byte_bpe_50k.json"), "")
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    for text in [*texts, "", " ", "<|endoftext|> x", "ça été\r\n\t 😀👩‍👩‍👧 　 １２３ ① ʼn", "a" * 3000, "\x00\x01", "한국어 中文 العربية"]:
        assert (fast(text) == slow(text)).all() if len(fast(text)) == len(slow(text)) else False


def test_runs_of_a_million_blanks(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain, fast = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.tokenizer(*packing.vocabulary())
    texts = ["a" + " " * 1_000_000 + "b c", "\n" * 1_000_000, "x \t\n\u3000" * 3 + "\t " * 600_000 + "y", ("\n" * packing.BLANKS + "z") * 3]
    for text in texts:
        assert fast(text).tolist() == plain.encode(text, add_special_tokens=False).ids
    assert [packing.long_blanks(t) for t in texts] == [True, True, True, False]
    got = packing.pack_documents(table(spark, [(1, texts[0], "en", "a"), (2, "x", "en", "a")]), *packing.vocabulary()).toPandas()
    assert got[got.doc_id == 1]["length"].sum() == len(fast(texts[0])) + 1 and (got.doc_id == 2).sum() == 1


def test_added_tokens_get_their_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain, fast = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.tokenizer(*packing.vocabulary())
    assert fast("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]
    end = "<|endoftext|>"
    for text in [end, end * 3, f"x\n\n{end}\n y", f"é {end}  {end} {end[:-1]}", f"{end}  ", f"a {end}" + "\n" * 1_000_000 + end]:
        assert fast(text).tolist() == plain.encode(text, add_special_tokens=False).ids
    got = packing.pack_documents(table(spark, [(1, f"a {end} b", "en", "a")]), *packing.vocabulary()).toPandas()
    assert got["length"].tolist() == [5] and got.ids_crc32.tolist() == [zlib.crc32(np.array([64, 220, 50256, 275, 0], dtype="<u4").tobytes())]


def test_packing(spark, odd, none):
    got = packing.pack_documents(odd, *packing.vocabulary()).toPandas()
    assert len(got[got.doc_id == 6]) == 2 and set(got[got.doc_id.isna()].piece) == {0}
    encode = packing.tokenizer(*packing.vocabulary())
    texts = {r.doc_id: r.text for r in odd.collect()}
    for doc_id, part in got[got.doc_id.notna()].drop_duplicates(["doc_id", "piece"]).groupby("doc_id"):
        ids = [*encode(texts[doc_id] or "").tolist(), 0]
        part = part.sort_values("piece")
        assert part["length"].sum() == len(ids) and (part["length"].iloc[1:] == 2048).all()
        for r in part.itertuples():
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], dtype="<u4").tobytes())
    for _, part in got.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert part["length"].sum() <= 2048 and list(part["offset"]) == [0, *part["length"].cumsum()[:-1]]
    assert packing.pack_documents(none, *packing.vocabulary()).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(rule):
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 1000, 600).astype(float)
    demands, limits = np.stack([sizes, np.ones(600), sizes**2], axis=1), np.array([2048, 5, 1.5e6])
    bins = packing.best_fit(demands, limits, np.array([1.0, 0.1, 0.1]), rule)
    for b in range(bins.max() + 1):
        assert (demands[bins == b].sum(axis=0) <= limits + 1e-6).all()
    assert bins.max() + 1 <= 1.25 * max(demands.sum(axis=0) / limits)


def brute_quality(text):
    text = text or ""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    grams = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for k in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_quality_rules(spark, sf_dir, odd, none):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = quality.op2(spark, sf_dir).toPandas()
    assert len(got) == len(texts)
    for r in got.itertuples():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_quality(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.base_failed and r.kept)
        verdict = not r.base_failed and not any(f(quality.Text(texts[r.doc_id])) for f in quality.RULES.values())
        assert r.kept == verdict
    for r in quality.judge(odd, order=list(quality.RULES)).toPandas().itertuples():
        text = next(t.text for t in odd.collect() if t.doc_id == r.doc_id) if r.doc_id == r.doc_id else "an id is missing here"
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_quality(text)
    assert quality.judge(none).count() == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas().merge(got, on="doc_id")
    clean = labels[(labels.quality == 1) & ~labels.base_failed]
    assert clean.kept.mean() > 0.98 and labels[labels.quality == 0].kept.mean() < 0.1


def test_cascade_order():
    import pandas as pd

    figures = pd.DataFrame({"rule": ["a", "b", "c"], "tried": 10, "rejected": [1, 5, 0], "seconds": [0.1, 1.0, 0.01]})
    assert quality.cascade_order(figures, dict.fromkeys("abc")) == ["a", "b", "c"]
    assert quality.cascade_order(figures.iloc[:0], dict.fromkeys("abc")) == ["a", "b", "c"]


def test_classifier(spark, sf_dir, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = classifier.score(docs, classifier.train(docs)).join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").toPandas()
    assert got[got.quality == 1].kept.mean() > 0.97 and got[got.quality == 0].kept.mean() < 0.1
    assert classifier.score(odd, classifier.train(odd)).count() == 14
    assert classifier.score(none, classifier.train(none)).count() == 0


def test_language_id(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(language.training_rows(docs))
    got = language.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(language.held_out(F.col("doc_id"))).toPandas()
    assert len(got) and (got.lang == got.lang_pred).mean() > 0.97 and got.score.between(0, 1).all()
    out = {r.doc_id: r for r in language.predict(odd, model).collect()}
    assert len(out) == 13 and all(out[i].lang_pred == "und" and out[i].score == 0 for i in (1, 2, 3, 10))
    assert language.accepted(odd, model).columns == odd.columns
    assert language.predict(none, model).count() == 0
    assert {r.lang_pred for r in language.predict(odd, language.fit(none)).collect()} == {"und"}
    one = language.fit(docs.filter("lang = 'en'"))
    assert {r.lang_pred for r in language.predict(docs.limit(20), one).collect()} <= {"en", "und"}


@pytest.mark.parametrize("n", [2, 4, 7, 30])
def test_codewords_differ(n):
    code = language.codewords(n)
    assert len({tuple(r) for r in code.tolist()}) == n and (abs(code.sum(axis=0)) < n).all()


def brute_components(texts, width, percent):
    sets = {}
    for i, t in texts.items():
        words = WORDS.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = set(zip(*[words[k:] for k in range(width)], strict=False)) if len(words) >= width else {tuple(words)} if words else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_minhash_against_brute_force(spark, sf_dir, odd, none):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for width, percent in ((3, 85), (5, 80)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_dups(docs, width, percent).collect()}
        assert got == brute_components(texts, width, percent)
    got = minhash.near_dups(odd.filter("doc_id is not null"), 3, 85).toPandas()
    want = brute_components({r.doc_id: r.text for r in odd.collect() if r.doc_id is not None}, 3, 85)
    assert len(got) == 13 and all((r.n_shingles, r.component_id) == want[r.doc_id] for r in got.itertuples())
    assert minhash.near_dups(odd, 3, 85).count() == 14
    assert minhash.near_dups(none).count() == 0


def test_minhash_chains_and_large_groups(spark):
    """Chains of edits, where no single centre is near all: every link counts."""
    rng = np.random.default_rng(5)
    words, rows = [f"w{i}" for i in range(300)], []
    for chain in range(4):
        text = [f"c{chain}{w}" for w in words]
        for step in range(25):
            for at in rng.integers(0, 300, 4):
                text[at] = f"e{chain}x{step}y{at}"
            rows.append((chain * 100 + step, " ".join(text), "en", "a"))
    docs = table(spark, rows)
    want = brute_components({r[0]: r[1] for r in rows}, 3, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_dups(docs, 3, 85).collect()} == want


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def brute_repeats(texts, width=100):
    seen, out = set(), {}
    for i in sorted(texts):
        raw = (texts[i] or "").encode()
        covered = bytearray(len(raw))
        for p in range(len(raw) - width + 1):
            w = raw[p : p + width]
            if w in seen:
                covered[p : p + width] = b"\1" * width
            else:
                seen.add(w)
        kept = bytes(x for x, c in zip(raw, covered, strict=True) if not c)
        runs = sum(covered[k] and not (k and covered[k - 1]) for k in range(len(raw)))
        out[i] = (len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [20_000, 2])
def test_suffix_dedup_against_brute_force(spark, sf_dir, hot):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(docs, hot=hot).collect()}
    assert got == brute_repeats(texts)


def test_suffix_dedup_odd_texts(spark, odd, none):
    rng = np.random.default_rng(1)
    base = bytes(rng.integers(97, 123, 3000, dtype=np.uint8)).decode()
    rows = [(1, base), (2, base[500:599]), (3, base[500:600]), (4, "é" * 200), (5, "ab" * 400), (6, base[:1000] + "!" + base[1000:]), (7, "x" * 50 + base[100:260] + "y" * 50 + base[100:260]), (8, ("q" * 99 + "r") * 5)]
    docs = table(spark, [(i, t, "en", "a") for i, t in rows])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == brute_repeats(dict(rows))
    want = brute_repeats({r.doc_id: r.text for r in odd.collect() if r.doc_id is not None})
    got = suffix_dedup.remove_repeats(odd).toPandas()
    assert len(got) == 14 and all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id] for r in got[got.doc_id.notna()].itertuples())
    assert got[got.doc_id.isna()].n_removed.sum() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_suffix_sort():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 4000, dtype=np.uint8)
    start = rng.permutation(3900)
    segment = np.sort(rng.integers(0, 7, 3900))
    order = polyhash.Suffixes(data, 20).sort(start, segment)
    raw = data.tobytes()
    keys = [(segment[i], raw[start[i] : start[i] + 20], i) for i in order]
    assert keys == sorted(keys)


def test_anchors_agree_between_equal_windows():
    rng = np.random.default_rng(4)
    core = rng.integers(97, 123, 100, dtype=np.uint8)
    places = set()
    for _ in range(20):
        data = np.concatenate([rng.integers(97, 123, 90, dtype=np.uint8), core, rng.integers(97, 123, 90, dtype=np.uint8)])
        grams = polyhash.window_hashes(polyhash.prefix_hashes(data), 40)
        place, first, last = polyhash.anchors(grams, 61)
        run = np.flatnonzero((first <= 90) & (last >= 90))
        places.add((int(place[run[0]]) - 90, int(grams[place[run[0]]])))
        assert (np.diff(first) == (last - first + 1)[:-1]).all() and last[-1] == len(grams) - 61
    assert len(places) == 1
