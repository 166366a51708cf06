"""Importance resampling, harmonic packing and conversation repair against plain versions, round trips and odd tables."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from conftest import rows_of

from tidemark.llm import conversations, harmonic, packing, resampling

SCHEMA = "doc_id long, text string, lang string, weight int, score string, rank int, bucket int, sequence_id string, offset int, _tie int, _pos int, start int"
LONG = " ".join(f"Word{i % 977}x{i % 13}" for i in range(30_000))
BIG = 1 << 60


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank and long texts, ties, repeated rows and ids, large and missing ids, columns whose names clash."""
    same = "the same twenty words " * 6
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, LONG), (BIG + 1, same), (BIG + 1, same), (BIG + 3, same), (None, same), (None, same), (None, "an id is missing"), (7, "ça été là 😀 naïve " * 9), (8, "a" * 70_000 + " b"), (9, "A-B_c 1" * 30), (10, "\x00\x01|<|endoftext|>|")]
    return spark.createDataFrame([(i, t, "en", 7, "x", 7, 7, "y", 7, 7, 7, 7) for i, t in texts], SCHEMA).repartition(3)


def plain_weights(docs, target, low, high, buckets=10_000, seed="2024", least=20, percent=10):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower))
    grams = lambda w: [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(low, high + 1) for i in range(len(w) - n + 1)]
    source = collections.Counter(b for _, t in docs for b in grams(words(t)))
    goal = collections.Counter(b for t in target for b in grams(words(t)))
    s_all, t_all = sum(source.values()), sum(goal.values())
    gain = lambda b: math.floor(1000 * math.log((goal[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets))))
    out = []
    for i, t in docs:
        found = grams(words(t))
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(t))))
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2]))
    drawn = able[: len(able) * percent // 100]
    return sorted([(*r, k + 1) for k, r in enumerate(drawn)] + [(*r, 0) for r in [*able[len(drawn) :], *(r for r in out if r[4] < least)]], key=str)


@pytest.mark.parametrize(("low", "high", "buckets", "percent"), [(1, 1, 10_000, 10), (1, 2, 500, 50), (2, 3, 10_000, 100)])
def test_resampling_is_that_of_a_plain_version(spark, sf_dir, odd, low, high, buckets, percent):
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    goal = [r.text for r in target.collect()]
    for docs in (odd, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        got = resampling.resample(docs, target, low, high, buckets, percent=percent).collect()
        want = plain_weights([(r.doc_id, r.text) for r in docs.collect()], goal, low, high, buckets, percent=percent)
        assert sorted(((r.doc_id, r.n_features, r.weight, r.score, r.n_words, r["rank"] or 0) for r in got), key=str) == want


def test_resampling_of_empty_tables(spark, odd):
    assert resampling.resample(odd.limit(0), odd).count() == 0
    got = resampling.resample(odd, odd.limit(0)).collect()
    assert len(got) == odd.count() and all(r.weight == 0 for r in got if not r.n_features)


def test_keys_are_those_of_the_library():
    rng = np.random.default_rng(1)
    data, starts, lengths = rng.integers(0, 256, 5000, dtype=np.uint8), rng.integers(0, 4900, 900), rng.integers(1, 60, 900)
    assert resampling.xxh64(data, starts, lengths).tolist() == [xxhash.xxh64_intdigest(data[a : a + n].tobytes()) for a, n in zip(starts, lengths, strict=True)]


@pytest.mark.parametrize("keys", [None, 0, 3])
def test_slots_belong_to_bytes_not_to_keys(keys):
    """With one key for all, or with three, the bytes alone tell the words apart; the last slot wraps round to the first."""
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abc"), rng.integers(1, 4))) for _ in range(300)]
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    lengths = np.array([len(w) for w in words])
    starts = np.cumsum(lengths + 1) - lengths - 1
    forced = None if keys is None else np.array([(1 << 64) - 1 - (len(w) if keys else 0) for w in words], dtype=np.uint64)
    grams = resampling.Grams(data, starts, lengths, forced)
    slots = collections.defaultdict(set)
    for w, s in zip(words, grams.slot.tolist(), strict=True):
        slots[w].add(s)
    assert all(len(s) == 1 for s in slots.values()) and len({next(iter(s)) for s in slots.values()}) == len(slots) == len(grams.used)
    counts, buckets = collections.Counter(words), grams.buckets(97)
    assert all(grams.count[next(iter(s))] == counts[w] and buckets[next(iter(s))] == zlib.crc32(w.encode()) % 97 for w, s in slots.items())


def check_sequences(got, docs, capacity=1024):
    """Every id in one piece, gapless sequences within the capacity; returns padding over tokens."""
    encode = packing.tokenizer(*packing.vocabulary())
    want = collections.Counter()
    for i, t in docs:
        ids = np.append(encode(t or ""), np.array([0])).astype("<u4")
        want[i, len(ids)] += 1
    pieces = collections.defaultdict(list)
    for r in got:
        pieces[r.doc_id, r.doc_tokens].append(r)
    assert {k: sum(r.length for r in v) for k, v in pieces.items()} == {k: n * k[1] for k, n in want.items()}
    texts = {(i, len(encode(t or "")) + 1): np.append(encode(t or ""), np.array([0])).astype("<u4") for i, t in docs}
    for key, own in pieces.items():
        if want[key] == 1:
            own.sort(key=lambda r: r.start)
            assert [r.start for r in own] == [0, *itertools.accumulate(r.length for r in own)][:-1]
            assert all(zlib.crc32(texts[key][r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in own)
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    padding = 0
    for own in sequences.values():
        own.sort()
        sizes = [n for _, n in own]
        assert [o for o, _ in own] == [0, *itertools.accumulate(sizes)][:-1] and sum(sizes) <= capacity
        padding += 0 if sum(sizes) & (sum(sizes) - 1) == 0 else capacity - sum(sizes)
    return padding / max(1, sum(n for own in sequences.values() for _, n in own))


def test_harmonic_packing(spark, sf_dir, odd):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert check_sequences(harmonic.op12(spark, sf_dir).collect(), [(r.doc_id, r.text) for r in docs.collect()]) < 0.002
    spread = harmonic.pack_harmonic(docs.repartition(40), *packing.vocabulary())
    assert check_sequences(spread.collect(), [(r.doc_id, r.text) for r in docs.collect()]) < 0.005
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    check_sequences(harmonic.pack_harmonic(odd, *packing.vocabulary()).collect(), rows)
    check_sequences(harmonic.pack_harmonic(odd, *packing.vocabulary(), capacity=100).collect(), rows, 100)
    assert harmonic.pack_harmonic(odd.limit(0), *packing.vocabulary()).count() == 0


@pytest.mark.parametrize("capacity", [1, 7, 100, 1024])
def test_pieces_fill_the_bins_of_their_class(capacity):
    for n in range(1, 3 * capacity + 1):
        lengths = harmonic.cut_lengths(n, capacity)
        assert sum(lengths) == n and all(capacity - capacity // x * x <= max(capacity / 64, capacity // x - 1) for x in lengths)
        assert sum(harmonic.powers(n)) == n


def test_bins_hold_a_fixed_count():
    """Full bins of class k hold k pieces, before the powers of two at the end."""
    packer = harmonic.Packer(0, 1024, harmonic.WASTE)
    import pyarrow as pa

    rng = np.random.default_rng(3)
    for _ in range(5):
        documents = [np.arange(n, dtype="<u4") for n in rng.integers(1, 3000, 200)]
        columns = packer.take(pa.array(range(200)), documents)
        sizes = collections.defaultdict(list)
        for length, sequence in zip(columns[2].to_pylist(), columns[5].to_pylist(), strict=True):
            sizes[sequence].append(length)
        assert all({1024 // x for x in own} == {len(own)} for own in sizes.values())
        assert sum(len(p[2]) for p in packer.open) < 1024 * len({1024 // len(p[2]) for p in packer.open})


PATTERN = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """(cost, letters, repaired lines) of the best of all edits with up to two inserts in a row, by trying them all."""
    best = None
    seen = set()
    facts = []
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        gone = not bare or (role, text) in seen
        seen.add((role, text))
        facts.append((role, text, gone, int(not gone and bare[-1] not in ".!?")))
    gap = [(), *[(r,) for r in ("user", "assistant")], *itertools.product(("user", "assistant"), repeat=2)]
    for ops in itertools.product("DKR", repeat=len(rows)):
        if any(f[2] and o != "D" for f, o in zip(facts, ops, strict=True)):
            continue
        for inserts in itertools.product(gap, repeat=len(rows) + 1):
            for roles in itertools.product(("user", "assistant"), repeat=ops.count("R")):
                roles, lines, cost, letters = list(roles), [], 0, ""
                for k, new in enumerate(inserts):
                    lines += [(r, "") for r in new]
                    cost, letters = cost + 2 * len(new), letters + "I" * len(new)
                    if k < len(rows):
                        role, text, _, extra = facts[k]
                        letters += ops[k]
                        cost += {"D": 3, "K": extra, "R": 2 + extra}[ops[k]]
                        if ops[k] != "D":
                            lines.append((roles.pop(0) if ops[k] == "R" else role, text))
                if PATTERN.fullmatch("".join(r[:1] or "?" for r, _ in lines)) and (best is None or (cost, letters) < best[:2]):
                    best = (cost, letters, lines)
    return best


@pytest.mark.parametrize("seed", range(12))
def test_edits_are_the_cheapest_of_all(seed):
    rng = np.random.default_rng(seed)
    for _ in range(8):
        n = int(rng.integers(0, 4))
        rows = [(str(rng.choice(["system", "user", "assistant", "tool", "", "Sys"])), str(rng.choice(["a.", "b", " ", "c!", "a.\n", "d?x"]))) for _ in range(n)]
        conversation = conversations.Conversation()
        for k, row in enumerate(rows):
            conversation.row(k, *row)
        gaps, *_, cost, audit, digest = conversation.result()
        want = cheapest(rows)
        assert (gaps, cost, audit) == (0, *want[:2])
        assert digest == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in want[2]).encode()).hexdigest()


@pytest.mark.parametrize("width", [4, 9, 64])
def test_short_integers_give_the_same_edits(width):
    rng = np.random.default_rng(5)
    for n in (0, 3, 40, 300):
        rows = [(str(rng.choice(list("suax"), p=[0.1, 0.4, 0.4, 0.1])), bool(rng.random() < 0.2), int(rng.random() < 0.3)) for _ in range(n)]
        small, large = conversations.Edits(width), conversations.Edits(4 * n + 8)
        for row in rows:
            small.row(*row)
            large.row(*row)
        assert small.result() == large.result() and large.settled == ""


def test_a_conversation_of_many_rows_and_bytes(spark):
    """One conversation of 20,000 rows is walked in linear time, its texts go through a file."""
    edits = conversations.Conversation()
    for k in range(20_000):
        edits.row(k, "user" if k % 2 == 0 or k % 31 == 0 else "assistant", f"turn {k} " * 130 + ("." if k % 17 else ""))
    gaps, blank, duplicate, truncated, illegal, cost, audit, _ = edits.result()
    assert (gaps, blank, duplicate) == (0, 0, 0) and truncated == -(-20_000 // 17) and illegal > 600 and len(edits.edits.settled) > 19_000 and edits.edits.width <= 1024
    assert audit.count("I") * 2 + audit.count("D") * 3 + audit.count("R") * 2 <= cost <= truncated + 2 * 650


def test_repair_of_odd_tables(spark):
    schema = "conv_id long, turn long, role string, text string, cost int, audit string, gaps int, _there string, present string, kind int, _kind int"
    rows = [
        (1, None, None, None), (1, 5, "user", "same."), (1, 5, "user", "same."), (1, 5, "assistant", "tie."), (1, 9, "assistant", "no end"), (None, 1, "system", "x."), (None, 2, "user", "é😀!"),
        (2, None, "user", "a."), (2, None, "assistant", "b."), (3, -(1 << 63), "user", "a."), (3, (1 << 63) - 1, "assistant", "b."), (BIG + 1, 1, "user", "\x0b\x0c"), (BIG + 3, 1, "", "z" * 300_000),
    ]
    table = spark.createDataFrame([(*r, 7, "x", 7, "y", "z", 7, 7) for r in rows], schema).repartition(3)
    got = {r.conv_id: r for r in conversations.repair(table).collect()}
    assert len(got) == 6 and got[1].blank == 1 and got[1].duplicate == 1 and got[1].gaps == 3 and got[1].truncated == 1
    assert got[None].audit == "KKI" and got[2].gaps == 0 and got[2].audit == "IKKI" and got[3].gaps == (1 << 63) - 1
    assert got[BIG + 1].audit == "D" and got[BIG + 1].blank == 1 and got[BIG + 1].repaired_sha256 == hashlib.sha256(b"").hexdigest() and got[BIG + 3].audit == "D"
    assert conversations.repair(table.limit(0)).count() == 0 and conversations.repair(conversations.damage(table.limit(0)), "present").count() == 0
    con = duckdb.connect()
    frame = table.select("conv_id", "turn", "role", "text").filter("conv_id is null or conv_id <> 3").toArrow()  # noqa: F841
    con.execute("CREATE VIEW conversations AS SELECT * FROM frame")
    damaged = conversations.repair(conversations.damage(table.filter("conv_id is null or conv_id <> 3")), "present")
    assert rows_of(damaged.toPandas()) == rows_of(con.execute(conversations.OP13_SQL).df())


def test_conversations_without_rows_are_zeros(spark):
    rows = [(i, 0, "user", "x.") for i in range(200)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in conversations.repair(conversations.damage(table), "present").collect()}
    gone = [i for i in range(200) if zlib.crc32(f"{i}:0".encode()) % 20 == 0]
    assert len(got) == 200 and gone
    assert all((got[i].cost, got[i].audit, got[i].illegal, got[i].repaired_sha256) == (0, "", 0, hashlib.sha256(b"").hexdigest()) for i in gone)
