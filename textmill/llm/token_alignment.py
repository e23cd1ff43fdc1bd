"""Cross-tokenizer alignment over distinct texts.

Documents are shuffled by their full text, so that each distinct text is tokenised and
aligned once. Tokens of both tokenizers are laid over the bytes of the text (a blank before
it); where a token of each ends at the same byte the text is cut, which makes groups of
tokens that cover the same bytes, and the two tokens that end there are linked. A pair of
ids counts its links over the whole corpus, each text's as often as the text occurs.

Texts are aligned in blocks of about ``BLOCK_CHARS`` characters. A block's pairs are
summed in its task before the shuffle that adds up the corpus, and look their counts up
once a block, so neither step sees a row per link. Measures per text come from a
cogroup of a block's texts with its pairs' counts, and are joined to the documents by the
text's digest, where a text that holds a third of all documents is one row on one side.

The vocabularies are read on the driver by path parameters and travel to the tasks; their
size is fixed. So is the bound of the one broadcast: a count per id of the second.

Defined results: a text that is null or empty, or whose tokens do not spell it (for
instance one that holds the mark U+2581, which stands for a blank), has no tokens: its
measures are 0 and its digest ''. Texts of any length are aligned whole; one longer than
a block is a block of its own. Repeated rows each get their text's measures. An empty table
gives an empty result. Columns named like a result are replaced by it; all others stay.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textmill.llm.common import col, fresh
from textmill.session import cut

BYTE_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
BLOCK_CHARS = 1 << 22
#: Fixed value: the pre-token pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts without such a character or run of blanks get the same ids, in a third of the time, from an encoder
#: made of the same vocabulary; classes of other characters differ between Unicode versions.
_UNUSUAL = re.compile(r"[^\t\n\r -~\xa0-\u024f]|\s{256}")
MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ALIGNED = (
    "block string, digest string, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, "
    "places array<int>, counts array<int>, pairs array<bigint>, weights array<bigint>"
)


class Vocabularies(NamedTuple):
    """Contents of the two vocabulary files."""

    a: str
    b: bytes


def read_vocabularies(path_a: str = BYTE_VOCABULARY, path_b: str = PIECE_VOCABULARY) -> Vocabularies:
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
        return Vocabularies(a.read(), b.read())


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for
    themselves, the rest, in order, for the letters from U+0100 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Coders(NamedTuple):
    a: Tokenizer
    fast_a: tiktoken.Encoding | None
    b: sentencepiece.SentencePieceProcessor
    bytes_a: list[bytes]
    bytes_b: list[bytes]
    sizes_a: np.ndarray
    sizes_b: np.ndarray


@lru_cache(maxsize=1)
def coders(vocabularies: Vocabularies) -> Coders:
    """Both tokenizers and every id's bytes; the strings of special tokens are plain text."""
    a = Tokenizer.from_str(vocabularies.a)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=vocabularies.b)
    letters, entries = byte_letters(), json.loads(vocabularies.a)["model"]["vocab"]
    bytes_a = [b""] * (max(a.get_vocab(with_added_tokens=True).values()) + 1)
    for entry, i in entries.items():
        if all(c in letters for c in entry):
            bytes_a[i] = bytes([letters[c] for c in entry])
    bytes_b = []
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        bytes_b.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace(MARK, " ").encode())
    sizes = [np.array([len(t) for t in table], np.int64) for table in (bytes_a, bytes_b)]
    model = json.loads(vocabularies.a)
    # Only where the file splits by that very pattern and ids follow the order of merges.
    whole = {entry: i for entry, i in entries.items() if all(c in letters for c in entry)}
    same = model["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["model"]["merges"]]
    same = same and not model["normalizer"] and [entries[m] for m in merged] == list(range(256, 256 + len(merged)))
    ranks = {bytes_a[i]: i for i in whole.values()}
    fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if same else None
    return Coders(a, fast, b, bytes_a, bytes_b, *sizes)


def first_ids(spaced: str, c: Coders) -> list[int]:
    """The first tokenizer's ids."""
    if c.fast_a is not None and not _UNUSUAL.search(spaced):
        return c.fast_a.encode_ordinary(spaced)
    return c.a.encode(spaced, add_special_tokens=False).ids


def token_ids(text: str, c: Coders) -> tuple[list[int], list[int]]:
    """The ids of both tokenizers; two empty lists where either does not spell the text."""
    spaced = " " + text
    a, b, data = first_ids(spaced, c), c.b.encode(text), spaced.encode()
    if b"".join(map(c.bytes_a.__getitem__, a)) != data or b"".join(map(c.bytes_b.__getitem__, b)) != data:
        return [], []
    return a, b


def align(a: np.ndarray, b: np.ndarray, c: Coders) -> tuple[np.ndarray, np.ndarray]:
    """Where a group ends: places of its last token in ``a`` and in ``b``, which cover the same bytes."""
    ends_a, ends_b = np.cumsum(c.sizes_a[a]), np.cumsum(c.sizes_b[b])
    marks = np.zeros(ends_a[-1] + 1, np.int8)
    marks[ends_a] = 1
    marks[ends_b] += 1
    return np.flatnonzero(marks[ends_a] == 2), np.flatnonzero(marks[ends_b] == 2)


@lru_cache(maxsize=4)
def _endings(size: int) -> list[str]:
    """Every id's decimals with each of the three signs that may follow."""
    return [f"{i}{sign}" for sign in ",|;" for i in range(size)]


def spell_groups(a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, size: int) -> str:
    """``a1,a2|b1;a3|b2,b3``: the groups' ids in order."""
    # A group's ids of one tokenizer stand behind all earlier ids of the other, its own of ``a`` before those of ``b``.
    before = np.concatenate(([0], last_b[:-1] + 1))
    out = np.empty(len(a) + len(b), np.int64)
    at_a = np.arange(len(a)) + np.repeat(before, np.diff(last_a, prepend=-1))
    at_b = np.arange(len(b)) + np.repeat(last_a + 1, np.diff(last_b, prepend=-1))
    out[at_a], out[at_b] = a, b
    out[at_a[last_a]] += size
    out[at_b[last_b]] += 2 * size
    table = _endings(size)
    return "".join(map(table.__getitem__, out.tolist()))[:-1]


def _block(texts: list[str], digests: list[str], times: list[int], c: Coders) -> pa.RecordBatch:
    """One row per text, and a last one with the block's pairs and how often each is linked."""
    rows, links, size = [], [], max(len(c.bytes_a), len(c.bytes_b))
    for text in texts:
        a, b = token_ids(text, c)
        if not a:
            rows.append((0, 0, 0, ""))
            links.append((np.empty(0, np.int64), np.empty(0, np.int64)))
            continue
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        last_a, last_b = align(a, b, c)
        spelt = spell_groups(a, b, last_a, last_b, size)
        rows.append((len(a), len(b), len(last_a), hashlib.sha256(spelt.encode()).hexdigest()))
        links.append(np.unique(a[last_a] * len(c.bytes_b) + b[last_b], return_counts=True))
    many = np.array([len(p) for p, _ in links])
    flat, counts = np.concatenate([p for p, _ in links]), np.concatenate([n for _, n in links])
    pairs, places = np.unique(flat, return_inverse=True)
    weights = np.zeros(len(pairs), np.int64)
    np.add.at(weights, places, counts * np.repeat(np.array(times, np.int64), many))
    at = pa.array(np.append(np.concatenate(([0], np.cumsum(many))), many.sum()), pa.int32())
    n, whole = len(texts), pa.array([0] * (len(texts) + 1) + [len(pairs)], pa.int32())
    measures = [pa.array([*[r[i] for r in rows], None], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
    arrays = [
        pa.array([digests[0]] * (n + 1)), pa.array([*digests, None], pa.string()), *measures,
        pa.ListArray.from_arrays(at, pa.array(places, pa.int32())), pa.ListArray.from_arrays(at, pa.array(counts, pa.int32())),
        pa.ListArray.from_arrays(whole, pa.array(pairs, pa.int64())), pa.ListArray.from_arrays(whole, pa.array(weights, pa.int64())),
    ]
    return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in ALIGNED.split(", ")])


def align_texts(docs: DataFrame, vocabularies: Vocabularies, text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Distinct texts' alignments, written to the shared folder: one row per text and, without a digest, one per block."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = coders(vocabularies)
        texts, digests, times, chars = [], [], [], 0
        for batch in batches:
            for text, digest, n in zip(*(column.to_pylist() for column in batch.columns)):
                if texts and chars + len(text) > block_chars:
                    yield _block(texts, digests, times, both)
                    texts, digests, times, chars = [], [], [], 0
                texts.append(text)
                digests.append(digest)
                times.append(n)
                chars += len(text)
        if texts:
            yield _block(texts, digests, times, both)

    texts = docs.select(col(text_col).cast("string").alias("text")).where("text <> ''").groupBy("text").agg(F.count("*").alias("n"))
    return cut(texts.select("text", F.sha2("text", 256).alias("digest"), "n").mapInArrow(blocks, ALIGNED), "aligned")


def pair_counts(aligned: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """``(pair, a_id, b_id, links, best)`` of every pair of ids linked anywhere; ``best`` pairs have
    their second id's highest count. Written to the shared folder."""
    size = sentencepiece.SentencePieceProcessor(model_proto=vocabularies.b).get_piece_size()
    rows = aligned.where("digest IS NULL").select(F.explode(F.arrays_zip("pairs", "weights")).alias("p"))
    counts = cut(rows.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.weights").alias("links")), "pairs")
    ids = counts.select("pair", F.floor(F.col("pair") / size).cast("bigint").alias("a_id"), (F.col("pair") % size).alias("b_id"), "links")
    # At most one row per id of the second vocabulary.
    tops = ids.groupBy("b_id").agg(F.max("links").alias("top"))
    return ids.join(F.broadcast(tops), "b_id").select("pair", "a_id", "b_id", "links", (F.col("links") == F.col("top")).alias("best"))


def _measure(texts: pa.Table, found: pa.Table) -> pa.Table:
    """One block's texts with the counts of their pairs summed up."""
    places, counts = (texts[c].combine_chunks() for c in ("places", "counts"))
    many = places.value_lengths().to_numpy(zero_copy_only=False)
    links, best = np.zeros(found.num_rows, np.int64), np.zeros(found.num_rows, np.int64)
    at = found["place"].to_numpy()
    links[at], best[at] = found["links"].to_numpy(), found["best"].to_numpy()
    here, times = places.flatten().to_numpy(), counts.flatten().to_numpy().astype(np.int64)
    stops = np.cumsum(many)

    def sums(values: np.ndarray) -> np.ndarray:
        upto = np.concatenate(([0], np.cumsum(values)))
        return upto[stops] - upto[stops - many]

    kept = [c for c in ("digest", "n_a", "n_b", "n_groups", "groups_sha256")]
    return pa.table({**{c: texts[c] for c in kept}, "n_links": sums(times), "n_best": sums(times * best[here]), "count_sum": sums(times * links[here])})


def measure_texts(aligned: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(digest, n_a, n_b, n_groups, groups_sha256, n_links, n_best, count_sum)`` of every distinct text."""
    wanted = aligned.where("digest IS NULL").select("block", F.posexplode("pairs").alias("place", "pair"))
    found = wanted.join(pairs.select("pair", "links", F.col("best").cast("bigint").alias("best")), "pair").select(
        F.col("block").alias("home"), "place", "links", "best"
    )
    texts = aligned.where("digest IS NOT NULL").select("block", "digest", "n_a", "n_b", "n_groups", "groups_sha256", "places", "counts")
    kind = "digest string, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, n_links bigint, n_best bigint, count_sum bigint"
    return cut(texts.groupBy("block").cogroup(found.groupBy("home")).applyInArrow(_measure, kind), "measures")


def align_documents(docs: DataFrame, vocabularies: Vocabularies, text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    aligned = align_texts(docs, vocabularies, text_col, block_chars)
    measures = measure_texts(aligned, pair_counts(aligned, vocabularies))
    extra = [c for c in docs.columns if c.lower() not in MEASURES]
    key, own = fresh(docs, "digest", "own_digest")
    rows = docs.select(*[col(c) for c in extra], F.sha2(col(text_col).cast("string"), 256).alias(key))
    joined = rows.join(measures.withColumnRenamed("digest", own), F.col(key) == F.col(own), "left")
    zeros = [F.coalesce(m, F.lit(0).cast("bigint")).alias(m) for m in MEASURES[:-1]]
    return joined.select(*[col(c) for c in extra], *zeros, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
