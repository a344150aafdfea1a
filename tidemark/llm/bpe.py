"""Byte-level BPE as a streaming transducer, and decoding as an incremental byte-to-text machine.

Encoding reads a text in pieces. A pre-token that fits the lookahead of the merge list is merged at once and
kept in a cache. A longer one runs through a transducer: ``last[n]`` is the token that ends the encoding of
its first n bytes, the one token t ending there that is stable next to ``last[n - len(t)]`` (the pair,
merged from its own bytes, gives the pair back). Any encoding passes through one of the last
``lookahead`` positions, where the lookahead is the longest token that the merges make; so a token is
stable, and emitted, once all of those positions go back to it. Memory holds the window and the tail that is
not yet decided, however long the text is.

Defined cases: a null text is empty and has no tokens; added tokens of the tokenizer file are found in texts
as the tokenizer itself finds them; ids that the vocabulary does not have decode to nothing; bytes
that are no UTF-8 decode to U+FFFD. Extra columns pass through, whatever their names.
"""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm.common import in_batches, slices, texts

# White space and the pre-token pattern of the public byte-level vocabulary.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
CHUNK = re.compile(rf"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
PRETOKEN = regex.compile(PATTERN)
CLASSES = (regex.compile(r"\p{L}+"), regex.compile(r"\p{N}+"), regex.compile(rf"[^{WHITE}\p{{L}}\p{{N}}]+"))

PIECE = 1 << 16
#: Lengths to try where no longer token starts.
SHORT = (3, 2, 1)
#: A chunk between white space that may enter the cache, and the entries it may hold.
CACHED_CHARS = 40
CACHE_ENTRIES = 600_000
#: A pre-token with more bytes goes through the transducer.
AT_ONCE = 512


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte: itself where printable, else 256 and up in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class ByteBPE:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        back = {c: b for b, c in byte_symbols().items()}
        vocab = data["model"]["vocab"]

        def raw(token: str) -> bytes:
            return bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()

        self.tokens: dict[int, bytes] = {i: raw(t) for t, i in vocab.items()}
        self.byte_id = [vocab[byte_symbols()[b]] for b in range(256)]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        #: The merge that makes each token: its rank and parts.
        self.made: dict[int, tuple[int, int, int]] = {}
        self.merged: dict[bytes, int] = {self.tokens[i]: i for i in self.byte_id}
        for rank, merge in enumerate(data["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs[vocab[a], vocab[b]] = (rank, vocab[a + b])
            self.made.setdefault(vocab[a + b], (rank, vocab[a], vocab[b]))
            self.merged[raw(a + b)] = vocab[a + b]
        #: Sufficient lookahead: an encoding has a token end among any so many positions in a row.
        self.lookahead = max(map(len, self.merged))
        self.added = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens |= {i: raw(t) for t, i in self.added.items()}
        some = "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))
        self.find_added = regex.compile(f"({some})") if some else None
        self.stable: dict[tuple[int, int], bool] = {}
        self.own: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.cache: dict[str, bytes] = {}
        #: The lengths of merged tokens by their first four bytes, falling to 1, and by their last two.
        starts: dict[bytes, set[int]] = {}
        ends: dict[bytes, set[int]] = {}
        for token in self.merged:
            if len(token) > 3:
                starts.setdefault(token[:4], {3, 2, 1}).add(len(token))
            ends.setdefault(token[-2:], set()).add(len(token))
        self.starts = {start: sorted(sizes, reverse=True) for start, sizes in starts.items()}
        self.ends = {end: sorted(sizes, reverse=True) for end, sizes in ends.items()}

    # -- pre-tokens that fit the lookahead ---------------------------------------------------------

    def merge(self, word: bytes) -> list[int]:
        """Applies the merge of least rank, leftmost first, until none is left."""
        ids = [self.byte_id[b] for b in word]
        get = self.pairs.get
        while len(ids) > 1:
            best = min((found for found in map(get, zip(ids, ids[1:], strict=False)) if found), default=None)
            if best is None:
                break
            out, i, last = [], 0, len(ids) - 1
            while i <= last:
                if i < last and get((ids[i], ids[i + 1])) == best:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def joint(self, a: int, b: int) -> bool:
        """Whether the encoding of both tokens' bytes is the two tokens."""
        known = self.stable.get((a, b))
        if known is None:
            known = self.alone(a) and self.alone(b) and not self.crossed(a, b)
            if len(self.stable) >= CACHE_ENTRIES:
                self.stable.clear()
            self.stable[a, b] = known
        return known

    def crossed(self, a: int, b: int) -> bool:
        """Whether a merge joins the end of ``a`` with the start of ``b`` while both are being made.

        Goes back in time: the two parts that face each other, each until the merge that took it in. A merge of the
        two is carried out if it comes before that of the left part, and before or at that of the right one
        (of equal merges the leftmost goes first).
        """
        made, pairs = self.made, self.pairs
        left_until = right_until = 1 << 60
        while True:
            found = pairs.get((a, b))
            if found and found[0] < left_until and found[0] <= right_until:
                return True
            at_left, at_right = made.get(a), made.get(b)
            if at_left is None and at_right is None:
                return False
            if at_right is None or (at_left is not None and at_left[0] > at_right[0]):
                left_until, a = at_left[0], at_left[2]
            else:
                right_until, b = at_right[0], at_right[1]

    def alone(self, a: int) -> bool:
        known = self.own.get(a)
        if known is None:
            known = self.own[a] = self.merge(self.tokens[a]) == [a]
        return known

    def word(self, raw: bytes) -> list[int]:
        """The only way through the bytes whose neighbours are all joint: longest tokens first, steps back where
        none fits. The encoding of each prefix is unique, so an end without a way on is dead for good."""
        n, at, ids, dead, most = len(raw), 0, [], None, 1 << 30
        merged, starts, stable = self.merged.get, self.starts.get, self.stable.get
        while at < n:
            for size in starts(raw[at : at + 4], SHORT):
                end = at + size
                if size > most or end > n:
                    continue
                token = merged(raw[at:end])
                if token is None or (dead and end in dead):
                    continue
                if ids:
                    fits = stable((ids[-1], token))
                    if fits is None:
                        fits = self.joint(ids[-1], token)
                else:
                    fits = self.alone(token)
                if fits:
                    ids.append(token)
                    at, most = end, 1 << 30
                    break
            else:
                dead = dead or set()
                dead.add(at)
                most = len(self.tokens[ids.pop()])
                at -= most
                most -= 1
        return ids

    def pretoken(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is not None:
            return found
        raw = word.encode("utf-8", "surrogatepass")
        if len(raw) <= AT_ONCE:
            found = _packed(self.word(raw))
            if len(word) <= CACHED_CHARS:
                if len(self.words) >= CACHE_ENTRIES:
                    self.words.clear()
                self.words[word] = found
            return found
        run = Transducer(self)
        return _packed([*run.feed(raw), *run.finish()])

    def chunk(self, text: str) -> bytes:
        """The ids of a chunk between white space as little-endian 32-bit numbers, cached if it is short."""
        found = self.cache.get(text)
        if found is None:
            found = b"".join(map(self.pretoken, PRETOKEN.findall(text)))
            if len(text) <= CACHED_CHARS:
                if len(self.cache) >= CACHE_ENTRIES:
                    self.cache.clear()
                self.cache[text] = found
        return found

    # -- streams ---------------------------------------------------------------------------------

    def plain(self, pieces: Iterable[str]) -> Iterator[bytes]:
        """Ids of a text without added tokens, given in pieces."""
        tail, open_, kind = "", None, None
        for piece in pieces:
            text, tail = tail + piece, ""
            if open_ is not None:  # a long pre-token goes on as long as its class does
                more = kind.match(text)
                if more:
                    yield _packed(open_.feed(more[0].encode("utf-8", "surrogatepass")))
                    text = text[more.end() :]
                if not text:
                    continue
                yield _packed(open_.finish())
                open_ = None
            chunks = CHUNK.findall(text)
            if not chunks:
                continue
            tail = chunks.pop()
            cached, chunk = self.cache.get, self.chunk
            yield b"".join([cached(c) or chunk(c) for c in chunks])
            if len(tail) > AT_ONCE:  # decide all but the last pre-tokens of an endless chunk
                words = PRETOKEN.findall(tail)
                keep = words[-2:] if len(words[-1]) <= AT_ONCE else words[-1:]
                yield b"".join(map(self.pretoken, words[: len(words) - len(keep)]))
                tail = "".join(keep)
                kind = next((k for k in CLASSES if k.fullmatch(tail.removeprefix(" "))), None)
                if kind is not None:
                    open_ = Transducer(self)
                    yield _packed(open_.feed(tail.encode("utf-8", "surrogatepass")))
                    tail = ""
        if open_ is not None:
            yield _packed(open_.finish())
        if tail:
            yield self.chunk(tail)

    def encode(self, text: str) -> bytes:
        """All ids of a text as little-endian 32-bit numbers."""
        parts = self.find_added.split(text) if self.find_added and any(t in text for t in self.added) else [text]
        out = []
        for part in parts:
            if part in self.added:
                out.append(_packed([self.added[part]]))
            elif part:
                out.extend(self.plain(part[i : i + PIECE] for i in range(0, len(part), PIECE)))
        return b"".join(out)

    def decode(self, ids: list[int]) -> Iterator[str]:
        """Text as soon as its bytes are whole; a machine holds at most three bytes back."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        table = self.tokens
        for i in range(0, len(ids), 4096):
            block = ids[i : i + 4096]
            try:
                raw = b"".join([table[i] for i in block])
            except KeyError:
                raw = b"".join([table.get(i, b"") for i in block])
            yield machine.decode(raw)
        yield machine.decode(b"", final=True)


def _packed(ids) -> bytes:
    return np.fromiter(ids, "<u4").tobytes()


class Transducer:
    """Encodes one pre-token from a stream of bytes; ``feed`` returns the ids that became stable."""

    def __init__(self, bpe: ByteBPE):
        self.bpe = bpe
        self.base = 0  # bytes already emitted
        self.bytes = bytearray()  # those that are not
        self.last: list[int] = [-1]  # the token that ends at each of their ends, -1 at the base

    def _step(self) -> None:
        end, bpe = len(self.last), self.bpe
        window = bytes(self.bytes[max(0, end - bpe.lookahead) : end])
        sizes = bpe.ends.get(window[-2:], ()) if end > 1 else ()
        for size in (*sizes, 1):
            token = bpe.merged.get(window[-size:]) if size <= end else None
            if token is None:
                continue
            before = self.last[end - size] if end > size else self.edge
            if bpe.alone(token) if before is None else bpe.joint(before, token):
                self.last.append(token)
                return
        raise ValueError("the merge list makes no token here")

    edge: int | None = None  # the token emitted last

    def _back(self, end: int) -> Iterator[tuple[int, int]]:
        """(start, token) of the encoding that ends at ``end``, from its end."""
        while end > 0:
            token = self.last[end]
            end -= len(self.bpe.tokens[token])
            yield end, token

    def feed(self, data: bytes) -> list[int]:
        out: list[int] = []
        for begin in range(0, len(data), 256):
            part = data[begin : begin + 256]
            self.bytes += part
            for _ in part:
                self._step()
            out += self._emit()
        return out

    def _emit(self) -> list[int]:
        """Emits up to the last position that the encodings of all ends in the lookahead share."""
        n = len(self.bytes)
        ends = range(max(0, n - self.bpe.lookahead + 1), n + 1)
        if ends[0] == 0:
            return []
        shared: set[int] | None = None
        for end in ends:
            path = {end} | {start for start, _ in self._back(end)}
            shared = path if shared is None else shared & path
        at = max(shared)
        if at == 0:
            return []
        ids = [token for _, token in self._back(at)][::-1]
        self.edge = ids[-1]
        self.base += at
        del self.bytes[:at]
        self.last = [-1, *self.last[at + 1 :]]
        return ids

    def finish(self) -> list[int]:
        ids = [token for _, token in self._back(len(self.bytes))][::-1]
        self.bytes.clear()
        self.last = [-1]
        return ids


@lru_cache(4)
def load(path: str) -> ByteBPE:
    """One per Python worker, with its cache."""
    return ByteBPE(path)


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def encode(documents: DataFrame, path: str, text: str = "text", to: str = "ids", drop: bool = False) -> DataFrame:
    """``documents`` with the ids of ``text`` in the array column ``to``; ``drop`` leaves the text out."""
    kept = [c for c in documents.columns if not (drop and c == text)]

    def run(batches):
        bpe = load(path)
        for batch in slices(batches, column=text):
            blobs = [bpe.encode(x) for x in texts(batch, text)]
            offsets = np.cumsum([0, *(len(b) // 4 for b in blobs)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(blobs), "<i4")))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], ids], [*kept, to])

    return in_batches(documents, run, f"{_schema(documents.select(*[f'`{c}`' for c in kept]))}, `{to}` array<int>")


def decode(rows: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``rows`` with the text of the array column ``ids`` in ``to``; a null array is empty."""
    names = rows.columns

    def run(batches):
        bpe = load(path)
        for batch in batches:
            lists = batch.column(ids)
            values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            out = [
                "".join(bpe.decode(values[b:e].tolist())) for b, e in zip(offsets[:-1], offsets[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*names, to])

    return in_batches(rows, run, f"{_schema(rows)}, `{to}` string")
