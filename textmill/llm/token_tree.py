"""Token counts that follow edits.

A document is cut into segments of whole pre-tokens. A boundary lies before a blank
or line feed that follows any other character than white space, and, for scripts
without blanks, between a letter and a punctuation mark: the pre-token pattern always
breaks there and what follows is split as if it stood alone, so a segment's tokens do
not depend on its neighbours. A binary tree over the segments keeps two sums at every
node, characters and tokens. An edit finds its segments by descending the
character sums, encodes them again, together with a neighbour where the edit spoilt
the boundary, and updates the sums on the way up; nothing else is encoded.

Trees are two arrays per document in heap order (node 1 is the whole text, node
``n`` has children ``2n`` and ``2n + 1``), so they can be stored beside the text.
Every document is handled by itself, without a shuffle.

Positions count code points of the text as it is when the edit's turn comes; they
and lengths are cut to the text, negative ones count as 0. Defined results: a null
text counts as empty and has 0 tokens; null edits, starts, lengths or insertions do
nothing, start at 0, remove or insert nothing. An empty table gives an empty result. A very
long text is one tree, held by its task with the text; a pre-token is never cut, so a run
of letters without a blank or mark is one segment however long it is.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import col, fresh

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-token pattern of that vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A segment ends at the first boundary after so many characters.
SEGMENT = 256
#: Letters of scripts that are written without blanks; each is a letter in every version of Unicode since 2.0.
_DENSE = "\u0e01-\u0e30\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
_MARKS = "!-/:-@\\[-`{-~\u3001-\u3003\u3008-\u3011\uff01-\uff0f\uff1a-\uff20"
_BOUNDARY = re.compile(f"(?<=\\S)[ \n]|(?<=[{_DENSE}])[{_MARKS}]")
#: Whether a boundary lies between the last character of one part and the first of the next.
_JOINT = re.compile(f"\\S[ \n]|[{_DENSE}][{_MARKS}]")
#: Long blank runs are encoded as the pre-tokens that the pattern makes of them, since its look-ahead would recurse.
_BLANKS = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{256,}")

Edit = tuple[int, int, str]


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    """The vocabulary file, read on the driver and shipped to the tasks; a fixed size of under 1 MB."""
    with open(path, "rb") as file:
        return file.read()


@lru_cache(maxsize=2)
def encoding(vocabulary: bytes, pattern: str = PATTERN) -> tiktoken.Encoding:
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str, coder: tiktoken.Encoding) -> int:
    """Tokens of a text that starts at a boundary and ends at one or at the text's end."""
    total, at = 0, 0
    for run in _BLANKS.finditer(text):
        # Before a visible character the last blank is left to the next pre-token.
        stop = run.end() - (run.end() < len(text))
        total += len(coder.encode_ordinary(text[at : run.start()])) + len(coder._encode_single_piece(text[run.start() : stop]))
        at = stop
    return total + len(coder.encode_ordinary(text[at:] if at else text))


def segments(text: str, size: int = SEGMENT) -> list[str]:
    parts, at = [], 0
    while at < len(text):
        found = _BOUNDARY.search(text, at + size)
        stop = found.start() if found else len(text)
        parts.append(text[at:stop])
        at = stop
    return parts


class TokenTree:
    """The segments of one text and the sums over them; ``recount`` counts the tokens of a segment."""

    def __init__(self, text: str, recount: Callable[[str], int], sums: tuple[list[int], list[int]] | None = None):
        self.recount, self.encoded = recount, 0
        if sums is None:
            parts = segments(text)
            self._fill(parts, [self._count(p) for p in parts])
        else:
            self.chars, self.tokens = list(sums[0]), list(sums[1])
            self.width = len(self.chars) // 2
            at, self.parts = 0, []
            for n in self.chars[self.width :]:
                self.parts.append(text[at : at + n])
                at += n

    def _count(self, part: str) -> int:
        self.encoded += len(part)
        return self.recount(part) if part else 0

    def _fill(self, parts: list[str], counts: list[int]) -> None:
        self.width = 1 << max(0, len(parts) - 1).bit_length()
        room = self.width - len(parts)
        self.parts = parts + [""] * room
        self.chars = [0] * self.width + [len(p) for p in self.parts]
        self.tokens = [0] * self.width + counts + [0] * room
        for node in range(self.width - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def _leaf(self, position: int) -> tuple[int, int]:
        """The segment that holds a position, or the last one, and the position inside it."""
        if position >= self.chars[1]:
            last = max((i for i in range(self.width - 1, -1, -1) if self.parts[i]), default=0) if not self.parts[-1] else self.width - 1
            return last, position - (self.chars[1] - len(self.parts[last]))
        node = 1
        while node < self.width:
            node *= 2
            if position >= self.chars[node]:
                position -= self.chars[node]
                node += 1
        return node - self.width, position

    def _put(self, leaf: int, part: str, count: int) -> None:
        self.parts[leaf] = part
        node = leaf + self.width
        self.chars[node], self.tokens[node] = len(part), count
        while node > 1:
            node //= 2
            self._sum(node)

    def edit(self, start: int, remove: int, insert: str) -> None:
        start = min(max(start, 0), self.chars[1])
        stop = min(start + max(remove, 0), self.chars[1])
        if start == stop and not insert:
            return
        first, inside = self._leaf(start)
        last, to = self._leaf(stop)
        region = self.parts[first][:inside] + insert + self.parts[last][to:]
        # Where the boundary beside the region is gone, or not known to hold, the neighbour joins.
        while first > 0 and not _JOINT.match(self.parts[first - 1][-1:] + region[:1]):
            first -= 1
            region = self.parts[first] + region
        while last + 1 < self.width and not _JOINT.match(region[-1:] + self.parts[last + 1][:1]):
            last += 1
            region += self.parts[last]
        parts = segments(region)
        slots = last - first + 1
        if len(parts) > slots:
            counts = self.tokens[self.width : 2 * self.width]
            rows = [(p, c) for p, c in zip(self.parts[:first], counts[:first]) if p]
            rows += [(p, self._count(p)) for p in parts]
            rows += [(p, c) for p, c in zip(self.parts[last + 1 :], counts[last + 1 :]) if p]
            self._fill([p for p, _ in rows], [c for _, c in rows])
            return
        for i in range(slots):
            part = parts[i] if i < len(parts) else ""
            self._put(first + i, part, self._count(part))

    @property
    def text(self) -> str:
        return "".join(self.parts)


_TREE = "tree_chars array<int>, tree_tokens array<int>, n_tokens bigint"


def _with(docs: DataFrame, rows, schema: str, *inputs: str) -> DataFrame:
    """``docs`` with the columns of ``schema`` that ``rows`` makes of the input columns."""

    def batches(groups: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for group in groups:
            yield pd.DataFrame([rows(*r) for r in zip(*group)], columns=names)

    def single(group: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from batches((s,) for s in group)

    names = [part.split()[0] for part in schema.split(", ")]
    extra = [c for c in docs.columns if c.lower() not in names]
    (made,) = fresh(docs, "made")
    if len(inputs) == 1:
        udf = F.pandas_udf(single, schema)
    else:
        udf = F.pandas_udf(batches, schema)
    out = docs.select(*[col(c) for c in extra], udf.asNondeterministic()(*[col(c) for c in inputs]).alias(made))
    return out.select(*[col(c) for c in extra], *[F.col(made)[n].alias(n) for n in names])


def build_trees(docs: DataFrame, vocabulary: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with ``tree_chars, tree_tokens`` and the count of the whole text, ``n_tokens``."""

    def rows(text: str | None) -> tuple:
        coder = encoding(vocabulary)
        tree = TokenTree(text or "", lambda part: count_tokens(part, coder))
        return tree.chars, tree.tokens, tree.tokens[1]

    return _with(docs, rows, _TREE, text_col)


def apply_edits(trees: DataFrame, vocabulary: bytes, edits_col: str = "edits", text_col: str = "text") -> DataFrame:
    """``trees`` after ``edits array<struct<start, remove, insert>>``, in order.

    The text, the tree and ``n_tokens`` are the new ones; ``encoded_chars`` is how
    much was encoded again.
    """

    def rows(text: str | None, chars, tokens, edits) -> tuple:
        coder = encoding(vocabulary)
        tree = TokenTree(text or "", lambda part: count_tokens(part, coder), (list(chars), list(tokens)))
        for edit in edits if edits is not None else ():
            if edit is not None:
                tree.edit(int(edit["start"] or 0), int(edit["remove"] or 0), edit["insert"] or "")
        return tree.text, tree.chars, tree.tokens, tree.tokens[1], tree.encoded

    schema = f"{text_col} string, {_TREE}, encoded_chars bigint"
    return _with(trees, rows, schema, text_col, "tree_chars", "tree_tokens", edits_col)
