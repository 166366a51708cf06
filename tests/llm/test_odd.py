"""Ids above 2**53, missing and repeated ids, clashing columns, through every operator; methods against plain versions."""

import collections
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_corpus import brute_components, brute_repeats

import corpus_pipeline
from tidemark.llm import classifier, common, exact_dedup, harmonic, language, minhash, mixing, packing, quality, resampling, sharding, suffix_dedup, warc

BIG = 1 << 60
WORDS = "river stone light garden winter paper silver morning quiet forest window bridge letter summer market island yellow number".split()


def prose(seed, n=60):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] for i in rng.integers(0, len(WORDS), n)) + "."


@pytest.fixture(scope="module")
def wild(spark):
    """Neighbouring large ids, rows without an id, one id with two texts and one with none, repeated rows, every internal column name."""
    texts = [prose(1), prose(1), prose(2), prose(3), prose(3), None, prose(4), prose(5), prose(5), "", prose(6), prose(6, 3000), "short", prose(7)]
    ids = [BIG + 1, BIG + 3, BIG + 5, None, BIG + 7, BIG + 7, BIG + 7, BIG + 9, BIG + 9, BIG + 11, None, BIG + 13, 5, 5]
    names = ["shard", "slot", "_u", "_group", "_copy", "_row", "_key", "_place", "_path", "_file", "_copies", "_by", "rank", "u", "at", "id", "stratum", "doc", "kept", "score", "piece", "sequence_id", "offset", "size", "digest", "run", "segment"]
    rows = [(i, t, "en", "s", None if t is None else len(t), *[7] * len(names)) for i, t in zip(ids, texts, strict=True)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in names)
    path = common.shared_dir(spark, "wild")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def ids_of(df, column="doc_id"):
    return collections.Counter(r[0] for r in df.select(column).collect())


def test_ids_pass_unchanged(spark, wild):
    want = ids_of(wild)
    assert ids_of(quality.judge(wild)) == want
    assert ids_of(language.predict(wild, language.fit(wild))) == want
    assert ids_of(classifier.score(wild, classifier.train(wild))) == want
    assert ids_of(suffix_dedup.remove_repeats(wild)) == want
    assert ids_of(exact_dedup.exact_dedup(wild)) == want
    assert ids_of(mixing.mix(wild)) == want
    assert ids_of(minhash.near_dups(wild)) == want
    packed = packing.pack_documents(wild, *packing.vocabulary())
    assert ids_of(packed.filter("piece = 0")) == want
    for _, part in packed.toPandas().groupby("sequence_id"):
        part = part.sort_values("offset")
        assert part["length"].sum() <= 2048 and list(part["offset"]) == [0, *part["length"].cumsum()[:-1]]
    out = sharding.shard(wild, 3)
    assert ids_of(out) == want and out.columns.count("shard") == 1 and out.agg(F.max("shard"), F.min("_u")).first() == (2, 7)
    copies = mixing.repeated(wild, mixing.mix(wild))
    assert copies.columns == wild.columns and {r[0] for r in copies.select("_copy").distinct().collect()} == {7} and {r[0] for r in copies.select("_copies").distinct().collect()} == {7}


def test_pages_with_large_and_missing_ids(spark):
    rows = [(BIG + 1, "same"), (BIG + 3, "same"), (None, "other"), (BIG + 5, None), (None, "same"), (BIG + 7, "x")]
    pages = spark.createDataFrame([(i, "http://a", h) for i, h in rows], "page_id long, url string, html string").coalesce(1)
    path = common.shared_dir(spark, "pages")
    got = warc.read_archives(warc.write_archives(pages, path), path)
    assert ids_of(got, "page_id") == collections.Counter(i for i, _ in rows)
    assert {r.page_id: r.refers_to for r in got.collect() if r.record_type == "revisit"} == {BIG + 1: BIG + 3, None: BIG + 3}


def test_near_copies_of_rows_without_an_id(spark, wild):
    got = [(r.doc_id, r.component_id, r.kept) for r in minhash.near_dups(wild, 3, 85).collect()]
    assert (BIG + 3, BIG + 1, False) in got and (BIG + 1, BIG + 1, True) in got
    assert got.count((None, BIG + 7, False)) == 1 and got.count((None, None, True)) == 1  # one shares the text of another id, one is alone
    assert got.count((BIG + 9, BIG + 9, True)) == 2 and all(kept == (i == c) for i, c, kept in got)
    rows = [(k, r.text) for k, r in enumerate(wild.collect())]
    keyed = minhash.near_rows(common.row_keyed(wild, "wild", columns=["doc_id", "text"]), 3, 85).collect()
    want = brute_components(dict(rows), 3, 85)
    assert {r._row: (r.n_shingles, r.group_row) for r in keyed} == want


def test_suffix_dedup_of_repeated_and_missing_ids(spark, wild):
    rows = sorted(((r.doc_id is None, r.doc_id or 0, k, r.text) for k, r in enumerate(wild.collect())))
    want = brute_repeats({n: text for n, (_, _, _, text) in enumerate(rows)})
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(wild).collect())
    assert got == collections.Counter((None if missing else i, *want[n]) for n, (missing, i, _, _) in enumerate(rows))


def test_common_passages_have_other_anchors(spark, monkeypatch):
    """A passage that all texts hold is common; with few other windows about it results stay those of brute force."""
    rng = np.random.default_rng(8)
    random = lambda n: bytes(rng.integers(97, 123, n, dtype=np.uint8)).decode()
    passage, other = random(260), random(130)
    texts = {i: random(int(rng.integers(0, 200))) + (passage if i % 5 else other) + random(int(rng.integers(0, 200))) for i in range(120)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(6)
    keyed = common.order_keyed(docs, "common", ["doc_id", "text"])
    found = suffix_dedup.common_anchors(keyed, 100, suffix_dedup.GRAM)
    assert 0 < len(found) < 20 and not len(suffix_dedup.common_anchors(keyed.limit(5), 100, suffix_dedup.GRAM))
    for hot in (20_000, 3):
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(docs, hot=hot).collect()}
        assert got == brute_repeats(texts)


def test_runs_are_told_apart_by_their_bytes():
    """Equal anchors and offsets over other bytes have other digests."""
    rng = np.random.default_rng(9)
    core = bytes(rng.integers(97, 123, 160, dtype=np.uint8))
    a = suffix_dedup.runs_of(b"x" + core, 100, 40)
    b = suffix_dedup.runs_of(b"y" + core, 100, 40)
    same = {(h, c, d) for h, c, d in zip(*a[:3], strict=True)} & {(h, c, d) for h, c, d in zip(*b[:3], strict=True)}
    assert len(a[0]) == len(b[0]) and len(same) == len(a[0]) - 1


def test_quality_estimate_looks_at_rows_of_the_cascade(spark, wild):
    figures = quality.estimate(wild)
    passing = sum(not quality.figures(quality.Text(r.text))[-1] for r in wild.collect())
    assert set(figures.rule) == set(quality.RULES) and (figures.tried == passing).all() and (figures.seconds > 0).all()


def test_decoding_is_that_of_a_plain_search(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.fit(language.training_rows(docs))
    for text in [r.text for r in docs.limit(80).collect()]:
        got = language.decide(text, model)
        counts = language.trigram_counts(text)
        if counts is None:
            assert got == ("und", 0.0, True)
            continue
        losses = []
        for word in model["code"]:
            loss = 0.0
            for bit, sign in enumerate(word):
                margin = language.DAMPING * sum(float(counts[k]) * float(model["weights"][k, bit]) for k in np.flatnonzero(counts))
                margin = max(-50.0, min(50.0, margin))
                loss += model["reliability"][bit] * len(word) * math.log1p(math.exp(-sign * margin))
            losses.append(loss)
        best = min(range(len(losses)), key=losses.__getitem__)
        shares = [math.exp(min(losses) - x) for x in losses]
        assert got[0] == model["langs"][best] and got[1] == pytest.approx(shares[best] / sum(shares), rel=1e-6)


def test_every_language_is_learned(spark):
    """300 languages of other letters each, held by tasks a few at a time: every one is predicted; 900 give a model as well."""
    rng = np.random.default_rng(21)
    words = [["".join(map(chr, rng.integers(97, 123, 5))) for _ in range(12)] for _ in range(900)]
    text = lambda i: " ".join(words[i][k] for k in np.random.default_rng(i).integers(0, 12, 60))
    rows = [(f"l{i:03d}", text(i)) for i in range(300)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    few, many = language.fit(docs, held=7), language.fit(docs)
    assert few["langs"] == many["langs"] == [r[0] for r in rows] and np.allclose(few["weights"], many["weights"])
    assert all(language.decide(t, many)[0] == lang for lang, t in rows)
    large = language.fit(spark.createDataFrame([(f"l{i:03d}", text(i)) for i in range(900)], "lang string, text string"))
    assert len(large["langs"]) == 900 == len({w.tobytes() for w in large["code"]})


def test_sums_by_bit_are_those_of_whole_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.lang, r.text) for r in language.training_rows(docs).select("lang", "text").collect()]
    model = language.fit(language.training_rows(docs))
    counts = {lang: np.zeros(language.BUCKETS) for lang in model["langs"]}
    for lang, text in rows:
        if (c := language.trigram_counts(text)) is not None:
            counts[lang] += c
    share = np.array([(counts[lang] + 0.5) / (counts[lang] + 0.5).sum() for lang in model["langs"]])
    for bit, word in enumerate(model["code"].T):
        assert np.allclose(model["weights"][:, bit], np.log(share[word > 0].mean(axis=0) / share[word < 0].mean(axis=0)), atol=1e-7)


def test_columns_called_metadata_and_smallest_ids(spark):
    """A column that hides the place of rows in files, an id without a negative, through operators and stages."""
    low = -(1 << 63)
    rows = [(low, prose(1), "en", "s", 1, "x"), (low + 1, prose(1), "en", "s", 1, "x"), (None, prose(1), "en", "s", 1, "x"), (3, prose(2), "en", "s", 1, "y"), (low, prose(3), "en", "s", 1, "z"), (7, None, "en", None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, `_Metadata` string"
    path = common.shared_dir(spark, "metadata")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    docs = spark.read.parquet(path)
    keyed = common.row_keyed(docs, "m")
    assert keyed.columns == [*docs.columns, "_row"] and keyed.select("_row").distinct().count() == 6 and {r[5] for r in keyed.collect()} == {"x", "y", "z", None}
    got = {(r.doc_id, r.text_sha256): r for r in exact_dedup.exact_dedup(docs).collect()}
    assert len(got) == 6 and {r.keep_id for r in got.values() if r.group_size == 3} == {low} and sum(r.kept for r in got.values()) == 4
    want = ids_of(docs)
    for out in (quality.judge(docs), language.predict(docs, language.fit(docs)), classifier.score(docs, classifier.train(docs)), suffix_dedup.remove_repeats(docs), mixing.mix(docs), minhash.near_dups(docs), sharding.shard(docs, 3), resampling.resample(docs, docs)):
        assert ids_of(out) == want
    assert ids_of(packing.pack_documents(docs, *packing.vocabulary())) == want == ids_of(harmonic.pack_harmonic(docs, *packing.vocabulary()).filter("start = 0"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, ""), "metadata")
        assert docs.columns[-1] == "_Metadata"
    assert {r.doc_id for r in docs.collect()} <= {low, 3} and docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() >= docs.count()


def test_rows_without_an_id_are_dealt_apart(spark):
    docs = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.col("id").alias("size"))
    out = sharding.shard(common.materialize(docs, "no-ids"), 7)
    assert out.select("shard", "slot").distinct().count() == 4000
    mean = out.groupBy("shard").agg(F.avg("size").alias("m")).agg(F.min("m"), F.max("m")).first()
    assert 1800 < mean[0] <= mean[1] < 2200


def test_rows_without_keys(spark):
    rows = common.materialize(spark.range(3000).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("text")), "rows")
    keys = common.materialize(spark.range(0, 3000, 7).toDF("k"), "keys")
    got = exact_dedup.without(rows, "k", keys)
    assert {r.k for r in got.collect()} == set(range(3000)) - set(range(0, 3000, 7)) and got.columns == rows.columns
    assert exact_dedup.without(rows, "k", keys.limit(0)).count() == 3000 and exact_dedup.without(rows.limit(0), "k", keys).count() == 0


def test_expectation_maximisation_finds_planted_accuracies():
    rng = np.random.default_rng(11)
    right = np.array([0.95, 0.9, 0.8, 0.7, 0.6])
    truth = rng.random(40_000) < 0.7
    votes = np.where(rng.random((len(truth), 5)) < 0.2, 1, np.where((rng.random((len(truth), 5)) < right) == truth[:, None], 2, 0))
    patterns = pd.Series(["".join("-0+"[v] for v in row) for row in votes]).value_counts()
    prior, tables = classifier.expectation_maximisation(pd.DataFrame({"votes": patterns.index, "n": patterns.to_numpy()}), 5)
    assert abs(prior - 0.7) < 0.02
    assert np.abs(tables[1, :, 2] - 0.8 * right).max() < 0.02 and np.abs(tables[0, :, 0] - 0.8 * right).max() < 0.03
    assert np.abs(tables[:, :, 1] - 0.2).max() < 0.02


def test_scorer_follows_soft_labels():
    rng = np.random.default_rng(12)
    x = rng.random((600, 8)) * np.array([1, 1, *[0.1] * 6])
    y = 1 / (1 + np.exp(-12 * (x[:, 0] - x[:, 1])))
    weights = classifier.fit_scorer(x, y, rounds=2000)
    guess = x @ weights[:-1] + weights[-1] > 0
    assert (guess == (y > 0.5)).mean() > 0.95 and weights[0] > 1 > -1 > weights[1]


def test_training_sample_is_bounded_and_repeats(spark):
    docs = spark.createDataFrame([(i, prose(i % 300, 30)) for i in range(900)], "doc_id long, text string").repartition(5)
    a, b = classifier.train(docs, train_rows=100), classifier.train(docs.repartition(3), train_rows=100)
    assert np.allclose(a["weights"], b["weights"], atol=1e-5)


def test_inclusion_odds_follow_the_factor(spark):
    """Of documents of one source, the odds of being drawn stand to each other as their factors do."""
    n = 20_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.lit("s").alias("source"), F.when(F.col("id") % 2 == 0, 4.0).otherwise(1.0).alias("f"))
    got = mixing.mix(docs, weights=(1,), share=0.4, chance="f").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.avg(F.col("copies").cast("double")).alias("p")).collect()
    p = {r.odd: r.p for r in got}
    ratio = p[0] / (1 - p[0]) / (p[1] / (1 - p[1]))
    assert abs(p[0] + p[1] - 0.8) < 0.01 and 3.6 < ratio < 4.4
    sizes = spark.range(n).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(if(id % 2 = 0, 400, 25) as int))").alias("text"), F.lit("s").alias("source"))
    p = {r.odd: r.p for r in mixing.mix(sizes, weights=(1,), share=0.5).groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.avg(F.col("copies").cast("double")).alias("p")).collect()}
    assert 3.6 < p[0] / (1 - p[0]) / (p[1] / (1 - p[1])) < 4.4  # 400/500 to 25/125


def test_document_capacity_binds(spark):
    rng = np.random.default_rng(13)
    lengths = [*rng.integers(1, 12, 3000).tolist(), *rng.integers(300, 2047, 1500).tolist()]
    pieces = common.materialize(spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, length long"), "pieces")
    most = packing.documents_per_sequence(pieces, 2048, slack=2.0)
    tight = packing.pack(pieces, documents=most).groupBy("sequence_id").agg(F.count("*").alias("n"), F.sum("length").alias("tokens"), F.sum(F.col("length") * F.col("length")).alias("cost")).toPandas()
    loose = packing.pack(pieces).groupBy("sequence_id").count().toPandas()
    assert tight.n.max() == most < loose["count"].max() and tight.tokens.max() <= 2048 and tight.cost.max() <= 2048**2
    with pytest.raises(Exception, match="above a capacity"):
        packing.pack(pieces, attention=1000).count()


def test_pipeline_of_wild_rows(spark, wild):
    docs, seen = wild, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, ""), f"wild-{name}")
        seen.append(sorted((str(r.doc_id), r.text) for r in docs.collect()))
        assert docs.columns == wild.columns and docs.filter("_row <> 7 or _copy <> 7 or shard <> 7").count() == 0
    language_kept, exact_kept, near_kept, mixed = seen
    assert len(exact_kept) == len({t for _, t in language_kept}) and {t for _, t in exact_kept} == {t for _, t in language_kept}
    assert (str(None), prose(3)) not in exact_kept and (str(BIG + 7), prose(3)) in exact_kept and (str(None), prose(6)) in near_kept
    assert set(mixed) <= set(near_kept)
    assert ids_of(corpus_pipeline.STAGES[-1][1](spark, docs, "").filter("piece = 0")) == ids_of(docs)


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_compaction_merges_runs_in_their_order(spark, sf_dir, broadcast):
    """Runs are shuffled when they are written, and neither shuffled nor sorted again when they are merged."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("entry"), F.length("text").alias("chars"), exact_dedup.sha256(F.col("text")).alias("digest"), F.pmod("doc_id", F.lit(4)).alias("run"))
    memtables = rows.groupBy("run", "digest").agg(F.count("*").alias("rows"), exact_dedup.best_row().alias("best"))
    flushed = common.bucketed(memtables.withColumn("segment", F.ascii(F.hex("digest")).cast("long")), "test_runs", "segment", ["segment", "digest"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        with common.sorted_scans(spark):
            merged = exact_dedup.compaction(flushed, 4)
            got = {bytes(r.digest): r.group_size for r in merged.collect()}
            plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        common.drop_bucketed(flushed)
    want = rows.groupBy("digest").count().filter("count > 1").collect()
    assert want and got == {bytes(r.digest): r["count"] for r in want}
    assert "Sort [" not in plan and "Exchange hashpartitioning" not in plan and "SortAggregate" in plan
