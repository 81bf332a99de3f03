"""Exact token counts at every prefix of a text, by dynamic programming.

Byte-level BPE has a useful property: the encoding of a prefix is the encoding
of a shorter prefix plus one last token, and a token may follow another exactly
when the two encode to themselves side by side.  So one pass over a piece finds
the last token, and with it the exact token count, of every prefix.  Pieces are
what the tokenizer's pattern cuts a text into; the counts of a text are those
of its pieces, chained.

``prefix_counts`` stores, for each document, the change of the token count at
every character (16-bit integers in one binary value).  From it any question
about truncation or budgets is answered without encoding again:
``count_at`` and ``longest_prefix`` read the stored counts.

Null texts count as empty; empty texts have no tokens.  The special string of
the vocabulary is one token, as the library reads it by default.  Repeated
rows and null ids give one row each.
"""

from __future__ import annotations

import json
import operator
import re
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.llm.common import WordMemo, map_batches, prepare

#: pieces of byte-level BPE texts (fixed value of the vocabulary)
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: a space that isn't alone between two words; such texts are cut by the pattern as a whole
LOOSE_SPACE = re.compile(r" \s|\s |^ | \Z")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def packed(counts: list[int]) -> bytes:
    """The changes from one count to the next, from 0, as 16-bit integers."""
    return struct.pack(f"<{len(counts)}h", *map(operator.sub, counts, [0, *counts]))


ONE_MORE = struct.pack("<h", 1)
#: bytes up to which the states of prefixes are shared between pieces
SHARED_PREFIX = 24


class PrefixCounter:
    """Token counts of all prefixes under one byte-level BPE vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()

        def as_bytes(token: str) -> bytes:
            return bytes(alphabet[c] for c in token)

        self.known = {as_bytes(t): k for k, t in enumerate(spec["model"]["vocab"])}
        self.token = list(self.known)
        self.rank = {}
        self.halves = {}
        for k, pair in enumerate(spec["model"]["merges"]):
            left, right = map(as_bytes, pair.split(" ") if isinstance(pair, str) else pair)
            self.rank[left, right] = k
            self.halves.setdefault(left + right, (left, right))
        self.longest = max(map(len, self.known))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.special_pattern = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.pattern = regex.compile(PIECES)
        self.right_edge = WordMemo(lambda t: self._edge(t, 1), 60_000)
        self.left_edge = WordMemo(lambda t: self._edge(t, 0), 60_000)
        self.alone = WordMemo(lambda k: self._encode(self.token[k]) == [self.token[k]], len(self.token))
        self.follows: dict[int, bool] = {}
        self.state: dict[bytes, tuple[bytes, tuple]] = {}
        self.spaced = WordMemo(self._spaced, 500_000)
        self.bare = WordMemo(self._bare, 100_000)

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, float]]:
        """The parts of a token that touch its right (1) or left (0) end, each with the rank of the merge that uses it up."""
        out, used_at = [(token, float("inf"))], None
        while token in self.halves:
            used_at = self.rank[self.halves[token]]
            token = self.halves[token][side]
            out.append((token, used_at))
        return out

    def _stands(self, left: bytes, right: bytes) -> bool:
        """Whether no merge crosses the border of two neighbouring tokens.

        A crossing merge needs both its parts still in place at its turn; of
        equal ranks the leftmost merges first.
        """
        rank = self.rank
        for x, x_used in self.right_edge[left]:
            for y, y_used in self.left_edge[right]:
                turn = rank.get((x, y))
                if turn is not None and x_used > turn and y_used >= turn:
                    return False
        return True

    def _encode(self, data: bytes) -> list[bytes]:
        """Plain BPE of a few bytes: repeatedly join the leftmost pair of the lowest rank."""
        parts = [data[k : k + 1] for k in range(len(data))]
        while len(parts) > 1:
            ranked = [(r, k) for k in range(len(parts) - 1) if (r := self.rank.get((parts[k], parts[k + 1]))) is not None]
            if not ranked:
                break
            _, k = min(ranked)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def _piece(self, data: bytes) -> list[int]:
        """Token count of data[:i] for i = 0 .. len(data).

        Exactly one token can be the last of a prefix; the likeliest, the last
        token of the prefix before with one byte more, is tried first.  The
        states of short prefixes (count, and last token of each) are kept and
        shared by all pieces that begin with them.
        """
        shared = self.state
        if len(shared) > 300_000:
            shared.clear()
        n = len(data)
        at = min(n, SHARED_PREFIX)
        while at and (found := shared.get(data[:at])) is None:
            at -= 1
        counts, last = (list(found[0]), list(found[1])) if at else ([0], [None])
        self._grow(data, counts, last)
        for end in range(max(at + 1, min(n - 2, SHARED_PREFIX)), min(n, SHARED_PREFIX) + 1):
            shared[data[:end]] = (bytes(counts[: end + 1]), tuple(last[: end + 1]))
        return counts

    def _grow(self, data: bytes, counts: list[int], last: list) -> None:
        """Carry counts and last tokens on from the prefix they end with to the whole of ``data``."""
        known, follows, longest = self.known, self.follows, self.longest
        size = len(self.token[last[-1]]) if len(counts) > 1 else 0
        for end in range(len(counts), len(data) + 1):
            # exactly one token fits; the likeliest is the last one with a byte more, then short ones
            start = first = end - 1 - size
            shorter = end
            while True:
                token = known.get(data[start:end])
                if token is not None:
                    if start:
                        pair = last[start] << 20 | token
                        ok = follows.get(pair)
                        if ok is None:
                            ok = self._follows(pair)
                    else:
                        ok = self.alone[token]
                    if ok:
                        break
                shorter -= 1 if shorter - 1 != first else 2
                start = shorter
                if start < 0 or end - start > longest:
                    raise ValueError(f"no encoding of {data[:end]!r}")
            counts.append(counts[start] + 1)
            last.append(token)
            size = end - start

    def learn(self, texts: list[str]) -> None:
        """Look up a batch's plain words beforehand, in sorted order: neighbours share the states of their common prefix."""
        words, spaced, fresh = set(), self.spaced, set()
        for t in texts:
            words.update(t.split(" "))
        for w in words:
            if w not in spaced:
                stem = w if w[-1:] not in (".", ",") else w[:-1]
                if stem.isalpha() and stem not in spaced:
                    fresh.add(stem)
        if len(spaced) + len(words) > spaced.limit:
            spaced.clear()
        before, counts, last = b"", [0], [None]
        for data, word in sorted([((" " + w).encode(), w) for w in fresh]):
            n = min(len(before), len(data))
            same = 0
            while same < n and before[same] == data[same]:
                same += 1
            del counts[same + 1 :], last[same + 1 :]
            self._grow(data, counts, last)
            before = data
            spaced[word] = packed(counts[1:] if len(data) == len(word) + 1 else self._characters(data, counts))

    @staticmethod
    def _characters(data: bytes, counts: list[int]) -> list[int]:
        """Counts where a character ends: before each byte that doesn't continue one, and at the end."""
        return [counts[k] for k in range(1, len(data)) if data[k] & 0xC0 != 0x80] + [counts[-1]]

    def _follows(self, pair: int) -> bool:
        if len(self.follows) > 400_000:
            self.follows.clear()
        ok = self.follows[pair] = self._stands(self.token[pair >> 20], self.token[pair & 0xFFFFF])
        return ok

    def _spaced(self, word: str) -> bytes:
        """Changes of the count over a space and the word after it."""
        return self._word(" ", word, self.spaced)

    def _bare(self, word: str) -> bytes:
        """Changes of the count over a word that begins a line."""
        return self._word("", word, self.bare)

    def _word(self, before: str, word: str, memo: WordMemo) -> bytes:
        if word.isalpha():
            return packed(self._by_character(before + word))
        if word[:-1].isalpha() and word[-1] in ".,":
            return memo[word[:-1]] + ONE_MORE
        left, line, right = word.partition("\n")
        if left and line and right and not (left[-1].isspace() or right[0].isspace()):
            # a line feed alone between two words is a piece of its own
            return memo[left] + ONE_MORE + self.bare[right]
        return self._deltas(before + word)

    def _by_character(self, piece: str) -> list[int]:
        """Counts of the prefixes of one piece, one per character."""
        data = piece.encode()
        counts = self._piece(data)
        if len(data) == len(piece):
            return counts[1:]
        return self._characters(data, counts)

    def _plain(self, text: str) -> list[int]:
        """Counts after each character of a text without special strings."""
        out: list[int] = []
        base = 0
        for m in self.pattern.finditer(text):
            piece = m.group()
            counts = self._by_character(piece)
            if len(piece) == 3 and piece[0] == "'" and piece in ("'re", "'ve", "'ll"):
                counts = [1, 2, counts[2]]  # "'r" alone is cut into two pieces
            if piece.isspace() or piece[0] == " ":
                # while a run of white space is the end of a prefix it is one piece
                start = len(text[: m.start()].rstrip()) if m.start() and text[m.start() - 1].isspace() else m.start()
                spaces = len(piece) if piece.isspace() else 1
                if start < m.start():
                    run = text[start : m.start() + spaces]
                    before = out[start - 1] if start else 0
                    inside = self._by_character(run)[-spaces:]
                    out.extend(before + c for c in inside)
                    out.extend(base + c for c in counts[spaces:])
                    base += counts[-1]
                    continue
            out.extend(base + c for c in counts)
            base += counts[-1]
        return out

    def counts(self, text: str) -> list[int]:
        """Token count of text[:i] for i = 1 .. len(text)."""
        if self.special_pattern is None or not any(s in text for s in self.special):
            return self._plain(text)
        out: list[int] = []
        base, at = 0, 0
        for m in [*self.special_pattern.finditer(text), None]:
            end = m.start() if m else len(text)
            special = m.group() if m else ""
            part = self._plain(text[at:end] + special[:-1])
            out.extend(base + c for c in part)
            if m:
                base += (part[end - at - 1] if end > at else 0) + 1
                out.append(base)
                at = m.end()
        return out

    def _deltas(self, text: str) -> bytes:
        return packed(self.counts(text))

    def deltas(self, text: str) -> bytes:
        """The change of the count at every character; words between single spaces are looked up."""
        if not text:
            return b""
        if LOOSE_SPACE.search(text) or any(s in text for s in self.special):
            return self._deltas(text)
        first, *rest = text.split(" ")
        return self._deltas(first) + b"".join(map(self.spaced.__getitem__, rest))


def count_at(deltas: bytes, chars: int) -> int:
    """Tokens of the first ``chars`` characters."""
    return int(np.frombuffer(deltas, "<i2")[:chars].sum())


def longest_prefix(deltas: bytes, budget: int) -> int:
    """Characters of the longest prefix with at most ``budget`` tokens."""
    within = np.flatnonzero(np.cumsum(np.frombuffer(deltas, "<i2"), dtype=np.int64) <= budget)
    return int(within[-1]) + 1 if len(within) else 0


def prefix_counts(docs: DataFrame, path: str, budget: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, fit_chars, prefix_deltas of every row.

    ``fit_chars`` is the longest prefix within ``budget`` tokens (the whole
    text without a budget).  ``path`` names the vocabulary on every worker.
    """
    prepare(docs.sparkSession)

    def make():
        counter = PrefixCounter(path)

        def step(batch: pa.RecordBatch):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            counter.learn(texts)
            stored = [counter.deltas(t) for t in texts]
            totals = [int(np.frombuffer(d, "<i2").sum()) for d in stored]
            fits = [len(d) // 2 if budget is None or n <= budget else longest_prefix(d, budget) for d, n in zip(stored, totals)]
            yield {"doc_id": batch.column(0), "n_bytes": batch.column(2), "n_tokens": totals, "fit_chars": fits, "prefix_deltas": stored}

        return step

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return map_batches(rows, make, "doc_id long, n_bytes long, n_tokens long, fit_chars long, prefix_deltas binary")
