"""SentencePiece (BPE) encoding and decoding with vectorised merge rounds.

The distinct words of a batch (a run of spaces and what follows it; no piece crosses such a border) lie as flat numpy
symbol arrays. Each round looks up the rank of every adjacent pair, takes the smallest rank of each word by a segmented
minimum, merges the leftmost such pair of every word at once (all its non-overlapping occurrences where no merge with the
new symbol can outrank it) and compacts the arrays, until no word has a pair left. In the same round every pair is merged
that no better pair is near: a piece has at most ``longest`` characters, so what happens farther away cannot reach it before
its turn. So the number of rounds does not grow with the length of a word. Characters outside the vocabulary become byte
pieces. Ids equal those of the sentencepiece library, without begin and end ids.

Defined cases: null counts as empty; empty text has no ids; texts of any length and words of any length are encoded whole,
by the same rounds; repeated rows get equal ids; an empty table gives no row; decoding of invalid bytes gives U+FFFD for each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm._common import process_cache, small_batches

SPACE = "▁"  # stands for a space in pieces
WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
NONE = np.iinfo(np.int32).max
LAST = np.iinfo(np.int64).max
CACHE_WORDS = 300_000


def _every_other(at: np.ndarray) -> np.ndarray:
    """Of rows of adjacent places the first, third, ... of each."""
    start = np.r_[True, np.diff(at) != 1][: len(at)]
    return (np.arange(len(at)) - np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))) % 2 == 0


def _least(key: np.ndarray, before: int, after: int) -> np.ndarray:
    """The smallest key from ``before`` places before to ``after`` places after each."""
    span, width = before + after + 1, 1
    now = np.full(len(key) + span - 1, LAST, key.dtype)
    now[before : before + len(key)] = key
    while 2 * width <= span:
        now = np.minimum(now[:-width], now[width:])
        width *= 2
    return np.minimum(now[: len(key)], now[span - width : span - width + len(key)])


class PieceCodec:
    """Tables of a SentencePiece BPE model with identity normalisation, dummy prefix and byte fallback."""

    def __init__(self, model_path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = sp.get_piece_size()
        special = lambda i: sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)
        text = [sp.id_to_piece(i) for i in range(size)]
        symbol = {p: i for i, p in enumerate(text) if not special(i)}
        score = {p: sp.get_score(i) for p, i in symbol.items()}
        rank_of = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.size = size
        self.byte_id = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        # Single characters that only occur inside pieces are symbols too; they are written as bytes if they stay alone.
        known = dict(symbol)
        for p in symbol:
            for c in p:
                known.setdefault(c, size + len(known))
        self.of_char = np.full(0x110000, -1, np.int32)
        for c, i in known.items():
            if len(c) == 1:
                self.of_char[ord(c)] = i
        self.wide = size + len(known) + 1
        pairs = {}
        for p, i in symbol.items():
            for cut in range(1, len(p)):
                left, right = known.get(p[:cut]), known.get(p[cut:])
                if left is not None and right is not None:
                    pairs[left * self.wide + right] = (rank_of[score[p]], i)
        self.pair = np.array(sorted(pairs), np.int64)
        self.rank = np.array([pairs[k][0] for k in self.pair.tolist()], np.int32)
        self.made = np.array([pairs[k][1] for k in self.pair.tolist()], np.int32)
        # A merge is safe for all occurrences at once if nothing made with its result has as good a rank.
        safe = np.ones(self.wide, bool)
        own = np.full(self.wide, -1, np.int64)
        own[self.made] = self.rank
        for part in (self.pair // self.wide, self.pair % self.wide):
            safe[part[(self.rank <= own[part]) & (own[part] >= 0)]] = False
        self.safe = safe
        self.starts_with_space = [p.startswith(SPACE) for p in text]
        self.longest = max(map(len, symbol))
        self.bytes_of = [b"" if sp.is_control(i) else bytes([int(p[3:5], 16)]) if sp.is_byte(i) else " ⁇ ".encode() if sp.is_unknown(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(text)]
        self.size_of = np.array([len(x) for x in self.bytes_of])
        self.start_of = np.r_[0, np.cumsum(self.size_of)[:-1]]
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = np.where((left < 0) | (right < 0), -1, left.astype(np.int64) * self.wide + right)
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        found = self.pair[at] == key
        return np.where(found, self.rank[at], NONE), self.made[at]

    def _merge_rounds(self, sym: np.ndarray, pos: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols, the position of the first character of each, and their words, after the last merge."""
        done: list[tuple[np.ndarray, ...]] = []
        born = np.zeros(len(sym), np.int64)  # a pair's turn is its rank, but never before its symbols are made
        while len(sym):
            rank, made = self._look_up(sym[:-1], sym[1:])
            rank = np.r_[np.where(word[:-1] == word[1:], rank, NONE), NONE].astype(np.int64)
            made = np.r_[made, 0][: len(rank)]
            turn = np.maximum(np.maximum(rank, born), np.r_[born[1:], 0])
            key = np.where(rank == NONE, LAST, (turn << 32) | rank)
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.repeat(np.minimum.reduceat(key, first), np.diff(np.r_[first, len(sym)]))
            over = best == LAST
            if over.any():
                done.append((sym[over], pos[over], word[over]))
                keep = ~over
                sym, pos, word, born, turn, key, best, made = (x[keep] for x in (sym, pos, word, born, turn, key, best, made))
                if not len(sym):
                    break
            at = np.flatnonzero(key == best)
            lead = np.r_[True, word[at][1:] != word[at][:-1]]  # the leftmost of each word
            take = at[lead | (self.safe[made[at]] & _every_other(at))]
            # What is best as far as a piece reaches: all of equal ones where the merge is safe (but not where their row begins
            # farther left than that), else the leftmost.
            near = (key == _least(key, self.longest, self.longest)) & (key != LAST)
            at = np.flatnonzero(near & self.safe[made])
            start = np.r_[True, np.diff(at) != 1][: len(at)]
            begins = (at == 0) | (key[at - 1] != key[at])
            at = at[_every_other(at) & begins[np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))]]
            alone = np.flatnonzero(near & (np.r_[LAST, _least(key, self.longest, 0)[:-1]] > key))
            at = np.union1d(np.union1d(take, at), alone)
            sym[at], born[at] = made[at], turn[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, pos, word, born = sym[keep], pos[keep], word[keep], born[keep]
        if not done:
            return sym, pos, word
        sym, pos, word = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.lexsort((pos, word))
        return sym[order], pos[order], word[order]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids (little-endian 32-bit) of each word, whose spaces are already SPACE."""
        size = np.array([len(w) for w in words], np.int64)
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sym, pos, word = self._merge_rounds(self.of_char[code], np.arange(len(code)), np.repeat(np.arange(len(words)), size))
        ids, owner = sym, word
        alone = (sym < 0) | (sym >= self.size)
        if alone.any():
            spelled = [self.byte_id[list(chr(c).encode())] if a else None for a, c in zip(alone.tolist(), code[pos].tolist(), strict=True)]
            many = np.array([1 if b is None else len(b) for b in spelled])
            ids, owner = np.repeat(sym, many), np.repeat(word, many)
            ids[np.repeat(alone, many)] = np.concatenate([b for b in spelled if b is not None])
        raw = ids.astype("<i4").tobytes()
        ends = 4 * np.searchsorted(owner, np.arange(len(words) + 1))
        return [raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def encoder(self):
        """List of texts to list of ids as bytes; words seen before are not merged again."""
        cache: dict[str, bytes] = {}  # by the word without the one space before it

        def split(text: str | None) -> list[str]:
            if not text:
                return []
            words = text.split(" ")
            if SPACE not in text and "" not in words:  # single spaces only: each word has one before it, the first one's is added
                return words
            return [w[1:] for w in WORD.findall(SPACE + text.replace(" ", SPACE))]

        def encode(texts: list[str | None]) -> list[bytes]:
            words = [split(t) for t in texts]
            seen = set().union(*words)
            if len(cache) + len(seen) > CACHE_WORDS:
                cache.clear()
            new = [w for w in seen if w not in cache]
            for k in range(0, len(new), 20_000):
                some = new[k : k + 20_000]
                cache.update(zip(some, self.encode_words([SPACE + w for w in some]), strict=True))
            return [b"".join(map(cache.__getitem__, ws)) for ws in words]

        return encode

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of lists of ids that lie one after another; ``ends`` are their borders (from 0)."""
        many = self.size_of[ids]
        at = np.cumsum(many)
        place = np.repeat(self.start_of[ids] - (at - many), many) + np.arange(int(at[-1]) if len(at) else 0)
        raw = self.all_bytes[place].tobytes()
        border = np.r_[0, at][ends].tolist()
        out = []
        for k, (a, b) in enumerate(zip(border[:-1], border[1:], strict=True)):
            lead = ends[k] < ends[k + 1] and self.starts_with_space[ids[ends[k]]]
            out.append(_readable(raw[a + lead : b]))
        return out

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        if len(ids) and self.starts_with_space[ids[0]]:
            raw = raw[1:]
        return _readable(raw)


def _readable(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return re.sub("[\udc80-\udcff]", "\ufffd", raw.decode(errors="surrogateescape"))


def _codec(model_path: str):
    """The tables of this worker, and an encoder that remembers words."""
    def make():
        codec = PieceCodec(model_path)
        return codec, codec.encoder()

    return process_cache(f"pieces {model_path}", make)


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids array<int> for each row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = _codec(model_path)[1]
        for b in batches:
            raw = to_ids(b["text"].to_pylist())
            ends = np.r_[0, np.cumsum([len(x) // 4 for x in raw])].astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(raw), "<i4"))
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.ListArray.from_arrays(pa.array(ends), flat)], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the decoded text; null ids decode to the empty text."""
    small_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_path)[0]
        for b in batches:
            ids = b["ids"]
            ends = np.r_[0, np.cumsum(np.asarray(ids.value_lengths().fill_null(0)))]
            texts = codec.decode_all(np.asarray(ids.flatten()), ends)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["ids"], pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
