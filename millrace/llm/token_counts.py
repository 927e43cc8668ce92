"""Token counts that follow edits: a segment tree over pre-token groups of each document.

A document is cut where a single space stands between two non-space characters, which always begins a pre-token of the
vocabulary, into leaves of about ``LEAF`` characters. The tree holds characters and tokens of each subtree. An edit (replace
``cut`` characters from ``start`` on by ``put``) re-encodes only the leaves that it touches and one leaf of context on either
side, which keeps the outer cuts valid, and updates the sums above them.

Edits of a document apply one after the other, each to the text that the edits before it left. Defined results: a null text is
empty; a start past the end means the end; negative starts or lengths count as 0; null edits are none; repeated rows are
counted each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import bpe
from millrace.llm.common import map_batches

LEAF = 160


class TokenTree:
    """Leaves of one document and the sums of their characters and tokens; leaf i is node ``size + i``."""

    def __init__(self, text: str, encoder: bpe.Encoder, leaf: int = LEAF):
        self.encoder, self.encoded = encoder, 0
        # a special token's string may hold blanks in other vocabularies: such texts stay one leaf
        self.whole = any(s in text for s in encoder.special)
        self.leaves = [text] if self.whole else self.split(text, leaf)
        self.size = 1
        while self.size < len(self.leaves):
            self.size *= 2
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, part in enumerate(self.leaves):
            self.chars[self.size + i], self.tokens[self.size + i] = len(part), self.count(part)
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @staticmethod
    def split(text: str, leaf: int) -> list[str]:
        out, begin, at = [], 0, leaf
        while at < len(text):
            cut = bpe.SAFE_CUT.search(text, at)
            if cut is None:
                break
            out.append(text[begin : cut.start()])
            begin = cut.start()
            at = begin + leaf
        return [*out, text[begin:]]

    def count(self, part: str) -> int:
        self.encoded += len(part)
        return len(self.encoder.ids(part)) if part else 0

    @property
    def total(self) -> int:
        return self.tokens[1]

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (the last one at the end) and the character's place in it."""
        if at >= self.chars[1]:
            i = max((i for i, p in enumerate(self.leaves) if p), default=0)
            return i, len(self.leaves[i])
        node = 1
        while node < self.size:
            node *= 2
            if at >= self.chars[node]:
                at -= self.chars[node]
                node += 1
        return node - self.size, at

    def put(self, i: int, part: str) -> None:
        self.leaves[i] = part
        node = self.size + i
        self.chars[node], self.tokens[node] = len(part), self.count(part)
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def beside(self, i: int, step: int) -> int:
        """The next leaf that isn't empty, or i itself at the border."""
        j = i + step
        while 0 <= j < len(self.leaves) and not self.leaves[j]:
            j += step
        return j if 0 <= j < len(self.leaves) else i

    def edit(self, start: int, cut: int, put: str) -> None:
        start = min(max(start, 0), self.chars[1])
        cut = min(max(cut, 0), self.chars[1] - start)
        if any(s in put for s in self.encoder.special) and not self.whole:
            text = "".join(self.leaves)
            self.whole = True
            for i in range(len(self.leaves)):
                self.put(i, text if i == 0 else "")
        i, offset = self.find(start)
        j, _ = self.find(max(start, start + cut - 1)) if cut else (i, 0)
        lo, hi = self.beside(i, -1), self.beside(j, 1)
        offset += sum(len(self.leaves[k]) for k in range(lo, i))
        region = "".join(self.leaves[lo : hi + 1])
        region = region[:offset] + put + region[offset + cut :]
        # one leaf takes the region unless it has grown too long for the others to stay empty
        parts = [region] if self.whole else self.split(region, max(LEAF, -(-len(region) // (hi - lo + 1))))
        parts = [*parts[: hi - lo], "".join(parts[hi - lo :])]
        for k in range(lo, hi + 1):
            self.put(k, parts[k - lo] if k - lo < len(parts) else "")


def count_edited(docs: DataFrame, path: str | None = None, leaf: int = LEAF) -> DataFrame:
    """Rows (doc_id, n_chars, n_tokens, n_edits, tokens_after, chars_after, chars_encoded) of (doc_id, text, edits).

    ``edits``: array of structs (start, cut, put). chars_encoded: characters that the edits made the encoder read again.
    """
    path = path or bpe.default_path()

    def run(batch: pa.RecordBatch) -> list:
        encoder, rows = bpe.encoder(path), []
        for text, edits in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            tree = TokenTree(text or "", encoder, leaf)
            before, chars, first = tree.total, tree.chars[1], tree.encoded
            edits = [e for e in edits or [] if e is not None]
            for e in edits:
                tree.edit(e["start"] or 0, e["cut"] or 0, e["put"] or "")
            rows.append((chars, before, len(edits), tree.total, tree.chars[1], tree.encoded - first))
        return [batch.column(0), *(pa.array(c, pa.int64()) for c in zip(*rows, strict=True))]

    key = docs.schema["doc_id"].dataType.simpleString()
    names = ["n_chars", "n_tokens", "n_edits", "tokens_after", "chars_after", "chars_encoded"]
    return map_batches(docs.select("doc_id", "text", "edits"), run, f"doc_id {key}, " + ", ".join(f"{n} bigint" for n in names))


def sample_edits(docs: DataFrame) -> DataFrame:
    """Documents with edits made of their own text: a cut, a swap of blanks, a passage put elsewhere, a word at the end."""
    n = F.length(F.coalesce("text", F.lit(""))).cast("int")
    place = lambda k: F.pmod(F.xxhash64("doc_id", F.lit(k)), F.greatest(n, F.lit(1))).cast("int")
    edit = lambda start, cut, put: F.struct(start.alias("start"), cut.cast("int").alias("cut"), put.alias("put"))
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", "text",
        F.array(
            edit(place(1), F.lit(40), F.lit("")),
            edit(place(2), F.lit(1), F.lit("  ")),
            edit(place(3), F.lit(0), F.substring(text, place(4), F.lit(120))),
            edit(n + 1000, F.lit(0), F.lit(" end")),
        ).alias("edits"),
    )
