"""Token counts: batch encoding in Arrow functions that return lengths only.

Record batches are cut into parts of about equal bytes. Every text is split where a
non-space character meets a space, tab, line feed or carriage return: byte-level BPE
pre-tokenisers never join characters across such a place (a piece may begin with white
space but none reaches over it, and no special string of the vocabulary holds white space),
so the counts of the pieces add up to the count of the whole text, whatever its length.
Pieces without white space that are longer than ``LONG_WORD`` characters are split further where
letters, digits and other characters meet, which such a pre-tokeniser never joins either; not behind an
apostrophe, which it joins with some letters, and not where a special string may stand.
Pieces met before in the task keep their length in a bounded memo; the others are encoded
in batches of about equal bytes. Sentencepiece models (.model) rewrite white space, and so may other
kinds of .json files: unless the file has no normaliser and the plain byte-level pre-tokeniser, texts
are encoded whole.

Null and empty texts have 0 tokens. Repeated rows are counted one by one. Columns named n_bytes,
n_tokens or over_limit are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerflow.llm.common import map_texts, text_bytes

#: Bytes of pieces in one call of the library.
BATCH_BYTES = 1 << 18
#: Entries after which a task forgets the lengths it has noted.
MEMO_ENTRIES = 300_000

#: Characters above which a piece is not noted.
LONG_PIECE = 64

_PIECES = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
_ODD_SPACE = re.compile(r"[^\S \t\n\r]")
_SAFE = re.compile(r"(?<=\S)(?=[ \t\n\r])")


#: Characters above which a piece without white space is split further.
LONG_WORD = 2048
_BETWEEN = regex.compile(r"(?V1)(?<=\p{L})(?=[^\p{L}\s])|(?<=\p{N})(?=[^\p{N}\s])|(?<=[^\s\p{L}\p{N}])(?=\p{N})|(?<=[^\s\p{L}\p{N}'])(?=\p{L})")


def pieces(text: str, special: tuple[str, ...] = ()) -> list[str]:
    """The text cut at its safe boundaries; ``special`` are strings that are never cut."""
    cut = _SAFE.split(text) if _ODD_SPACE.search(text) else _PIECES.findall(text)
    if max(map(len, cut), default=0) <= LONG_WORD:
        return cut
    out: list[str] = []
    for piece in cut:
        whole = len(piece) <= LONG_WORD or any(s in piece for s in special)
        out += [piece] if whole else _BETWEEN.split(piece)
    return out


def splits_safely(model: dict) -> bool:
    """Whether a tokenizer file cuts texts as this module takes it to."""
    cut = model.get("pre_tokenizer") or {}
    return not model.get("normalizer") and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)


class Counter:
    """Token counts of texts, as the library gives them for each whole text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.pieces = path.endswith(".model")
        self.whole, self.special = self.pieces, ()
        self.memo: dict[str, int] = {}
        if self.pieces:
            from sentencepiece import SentencePieceProcessor

            self.library = SentencePieceProcessor(model_file=path)
        else:
            from tokenizers import Tokenizer

            with open(path, encoding="utf-8") as file:
                model = json.load(file)
            self.special = tuple(t["content"] for t in model.get("added_tokens") or ())
            self.whole = not splits_safely(model) or any(re.search(r"\s", s) for s in self.special)
            self.library = Tokenizer.from_file(path)
            self.library.no_truncation()
            self.library.no_padding()

    def learn(self, unseen: list[str]) -> None:
        part: list[str] = []
        held = 0
        for piece in unseen:
            part.append(piece)
            held += len(piece) if piece.isascii() else len(piece.encode(errors="replace"))
            if held >= BATCH_BYTES:
                self._encode(part)
                part, held = [], 0
        self._encode(part)

    def _encode(self, part: list[str]) -> None:
        if part:
            for piece, e in zip(part, self.library.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.memo[piece] = len(e)

    def count(self, texts: list[str]) -> list[int]:
        if self.pieces:
            return [len(e) for e in self.library.encode(texts, num_threads=1)]
        if self.whole:
            return [len(e) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        cut = [pieces(t, self.special) for t in texts]
        unseen = [p for p in set().union(*cut) if p not in self.memo]
        if len(self.memo) + len(unseen) > MEMO_ENTRIES:
            self.memo.clear()
            unseen = list(set().union(*cut))
        self.learn(unseen)
        counts = [sum(map(self.memo.__getitem__, c)) for c in cut]
        for piece in unseen:
            if len(piece) > LONG_PIECE:
                del self.memo[piece]
        return counts


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", limit: int = 512, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (n_tokens > ``limit``) for every whole text."""
    new = [("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("over_limit", T.BooleanType())]

    def make():
        counter = Counter(path)

        def work(texts: pa.Array) -> list[pa.Array]:
            _, offsets = text_bytes(texts)
            n = counter.count([t or "" for t in texts.to_pylist()])
            return [pa.array(offsets[1:] - offsets[:-1], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())]

        return work

    return map_texts(docs, text_col, new, make, keep)
