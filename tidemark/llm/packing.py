"""Best-fit packing of tokenized documents into sequences under three capacities.

Every piece is a vector: tokens, documents (1) and attention cost (length squared). Pieces are dealt to groups of
about ``GROUP`` by a hash, and each group packs its pieces, largest first, into its own bins: of the bins whose
residual holds the piece in every dimension, the one with the best score takes it (smallest weighted norm of what
stays free, or largest weighted dot product of piece and residual). At most one bin of a group stays below half
full, so groups of thousands cost next to nothing against packing all pieces together, and no task grows with the input.
Texts never leave the scan: only piece metadata is shuffled.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import checked, fresh, map_carried, materialize, ship

GROUP = 4096
#: Documents that a sequence may hold, as a multiple of the mean; weights of tokens, documents and attention in the score.
SLACK, WEIGHTS = 8.0, (1.0, 1.0, 1.0)
#: Longest run of blanks that tiktoken gets: its split pattern overflows a stack of a million entries, one for each blank.
BLANKS = 100_000
_RUNS = re.compile(r"\s+")
_TOKENIZERS: dict = {}


def long_blanks(text: str) -> bool:
    """Whether the text has a run of more than ``BLANKS`` blanks."""
    return len(text) > BLANKS and any(m.end() - m.start() > BLANKS for m in _RUNS.finditer(text))


def tokenizer(path: str, pattern: str):
    """A function from text to uint32 ids for a byte-level vocabulary file, cached per worker.

    ``.tiktoken`` files hold the ranks of the vocabulary and are read by tiktoken, which gives the ids of the
    ``tokenizers`` library for the ``.json`` file of the same name several times faster (tests hold one against the other). Added tokens such as <|endoftext|> are
    in the ``.json`` file alone; where a text has them, they get their own ids. Texts with a very long
    run of blanks, on which tiktoken fails, are left to ``tokenizers`` and the ``.json`` file.
    """
    if path not in _TOKENIZERS:
        if path.endswith(".tiktoken"):
            import base64
            import json

            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            whole = path.removesuffix(".tiktoken") + ".json"
            with open(whole, encoding="utf-8") as f:
                added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
            coder = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)

            def encode(text: str) -> np.ndarray:
                if long_blanks(text):
                    return tokenizer(whole, pattern)(text)
                some = any(token in text for token in added)
                return np.asarray(coder.encode(text, allowed_special="all") if some else coder.encode_ordinary(text), dtype="<u4")

            _TOKENIZERS[path] = encode
        else:
            from tokenizers import Tokenizer

            slow = Tokenizer.from_file(path)
            _TOKENIZERS[path] = lambda text: np.asarray(slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
    return _TOKENIZERS[path]


def cut(ids: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: one if it fits, else a first one of what full pieces leave over."""
    first = len(ids) % capacity or capacity
    starts = [0, *range(first, len(ids), capacity)]
    return list(zip(starts, np.diff([*starts, len(ids)]).tolist(), strict=True))


def tokenize(docs: DataFrame, path: str, pattern: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) of all rows; null text counts as empty and has the end id alone."""

    def work():
        encode = tokenizer(path, pattern)

        def pieces(texts: list) -> tuple:
            rows, out = [], []
            for row, text in enumerate(texts):
                ids = np.append(encode(text or ""), np.array([end_id], dtype="<u4")).astype("<u4")
                for number, (start, length) in enumerate(cut(ids, capacity)):
                    rows.append(row)
                    out.append((number, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            return rows, list(zip(*out, strict=True)) or [[]] * 4

        return pieces

    return map_carried(docs, ["doc_id"], ["text"], work, "piece int, start long, length long, ids_crc32 long")


def best_fit(demands: np.ndarray, capacities: np.ndarray, weights: np.ndarray, rule: str) -> np.ndarray:
    """Bin number of each item. ``demands`` is items x dimensions, each item at most the capacities."""
    share = demands / capacities
    order = np.argsort(-share.max(axis=1), kind="stable")
    least = np.minimum.accumulate(share[order][::-1], axis=0)[::-1]  # the smallest demands still to come
    free, names, bins, opened = np.empty((0, share.shape[1])), np.empty(0, dtype=np.int64), np.empty(len(demands), dtype=np.int64), 0
    room = np.empty((64, share.shape[1]))
    label = np.empty(64, dtype=np.int64)
    used = 0
    for at, item in enumerate(order):
        need = share[item]
        if at % 256 == 0 and used:  # close bins that hold none of the items to come
            keep = (room[:used] >= least[at] - 1e-12).all(axis=1)
            used_now = int(keep.sum())
            room[:used_now], label[:used_now] = room[:used][keep], label[:used][keep]
            used = used_now
        free = room[:used] - need
        fits = np.flatnonzero((free >= -1e-12).all(axis=1))
        if len(fits):
            left = free[fits]
            score = (left * left) @ weights if rule == "norm" else -(room[fits] * need) @ weights
            best = fits[np.argmin(score)]
            room[best] -= need
            bins[item] = label[best]
            continue
        if used == len(room):
            room, label = np.vstack([room, np.empty_like(room)]), np.append(label, np.empty_like(label))
        room[used], label[used], bins[item] = 1 - need, opened, opened
        used, opened = used + 1, opened + 1
    return bins


def documents_per_sequence(pieces: DataFrame, tokens: int, slack: float = SLACK) -> int:
    """A document capacity from the data: ``slack`` times the pieces that a sequence would hold if all held as many."""
    rest = pieces.filter(F.col("length") < tokens).agg(F.count("*").alias("n"), F.sum("length").alias("tokens")).first()
    return max(1, math.ceil(slack * rest["n"] * tokens / rest["tokens"])) if rest["n"] else 1


def pack(pieces: DataFrame, tokens: int = 2048, documents: int = 2048, attention: int | None = None, weights: tuple = WEIGHTS, rule: str = "norm", group: int = GROUP) -> DataFrame:
    """Add sequence_id and offset to a (materialized) table of pieces with a column ``length`` up to ``tokens``.

    A sequence holds at most ``tokens`` tokens, ``documents`` pieces and ``attention`` summed squared lengths (default: as
    many as one piece of all tokens costs); a piece that breaks a capacity alone fails the job. Repeated rows are pieces of
    their own, an empty table gives none. Pieces that fill the token capacity are sequences by themselves (negative
    numbers) and skip the shuffle. Further columns, whatever their names, are kept as they are.
    """
    if rule not in ("norm", "dot"):
        raise ValueError("rule must be norm or dot")
    ship(pieces.sparkSession)
    limits, weight = np.array([tokens, documents, attention or tokens * tokens], dtype=float), np.array(weights, dtype=float)
    names, group_name = pieces.columns, fresh(pieces, "_group")
    rest = pieces.filter(F.col("length") < tokens)
    alone = pieces.filter(F.col("length") == tokens).select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    if limits[2] < tokens * tokens:
        alone = checked(alone, F.lit(False), "a piece is above a capacity by itself")
    groups = max(1, -(-rest.count() // group))
    dealt = rest.select("*", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(1)), F.lit(groups)).alias(group_name))
    at = names.index("length")

    def fill(table: pa.Table) -> pa.Table:
        order = [(n, "ascending") for n, t in zip(names, table.schema.types, strict=False) if not pa.types.is_nested(t)]
        table = table.sort_by(order)  # the same sequences at every run
        length = table.column(at).to_numpy().astype(float)
        demands = np.stack([length, np.ones(len(length)), length * length], axis=1)
        if (demands > limits).any():
            raise ValueError("a piece is above a capacity by itself")
        bins = best_fit(demands, limits, weight, rule)
        by_bin = np.argsort(bins, kind="stable")
        ends = np.cumsum(length[by_bin])
        fresh_bin = np.concatenate([[True], bins[by_bin][1:] != bins[by_bin][:-1]])
        offset = np.empty(len(bins), dtype=np.int64)
        offset[by_bin] = ends - length[by_bin] - (ends - length[by_bin])[np.flatnonzero(fresh_bin)][np.cumsum(fresh_bin) - 1]
        number = bins + (int(table.column(len(names))[0].as_py()) << 32)
        table = table.remove_column(len(names))
        return table.append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offset))

    schema = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return dealt.groupBy(group_name).applyInArrow(fill, schema).unionByName(alone)


def pack_documents(docs: DataFrame, path: str, pattern: str, capacity: int = 2048, documents: int | None = None, **caps) -> DataFrame:
    """Tokenize, cut and pack the rows of ``docs`` (doc_id, text). Without a document capacity, the data give one.

    Null and empty texts are pieces of the end id alone; rows without an id or that repeat one are documents of their own;
    an empty table gives none; further columns are ignored.
    """
    pieces = materialize(tokenize(docs, path, pattern, capacity), "pack-pieces")
    return pack(pieces, tokens=capacity, documents=documents or documents_per_sequence(pieces, capacity), **caps)


def vocabulary() -> tuple[str, str]:
    """Path and split pattern of the byte-level vocabulary of 50,257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1(spark, sf_dir: str) -> DataFrame:
    """All of ``documents`` in sequences of at most 2048 tokens, of documents up to a capacity that the data give, and of the attention cost of one full piece."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), *vocabulary())
