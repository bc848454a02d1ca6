"""Byte-level BPE encoding as a bounded-lookahead streaming transducer, and incremental decoding.

Text streams through two stages that hold a bounded number of characters:

* the splitter cuts the stream into pieces (the published pattern of byte-level vocabularies). A piece
  is final once the characters that could still change it have been seen; a piece that outgrows the
  buffer goes on as an open run;
* the merger turns pieces into tokens. Inside an open run the last ``lookahead`` bytes may still
  change the tokens, the ones before can't; these are emitted and forgotten.

``lookahead`` is computed from the merge list (see ``sufficient_lookahead``): tokens that end that many
bytes before the end of what is known are those of every continuation, and a sequence whose tokens
have a boundary at some place is merged alike in two parts cut there (no merge crosses the cut). This
is the streaming view of BPE in Berglund and van der Merwe, "Formalizing BPE Tokenization" (2023).
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm import words as W

#: Fixed value: the published split pattern of byte-level BPE vocabularies (white space by its Unicode property).
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Characters after a piece's end that can still change it: a contraction has three characters.
SETTLE = 3
#: Characters that the splitter takes at a time, and from which a piece becomes an open run.
CHUNK = 1 << 16
#: Pieces whose ids a worker remembers at most, of PIECE characters at most.
MEMORY = 250_000
PIECE = 64

_SPLIT = regex.compile(PATTERN)
_RUNS = {"L": regex.compile(r"\p{L}+"), "N": regex.compile(r"\p{N}+"),
         "O": regex.compile(r"[^\p{White_Space}\p{L}\p{N}]+"), "S": regex.compile(r"\p{White_Space}+")}


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file, and its byte: printable
    Latin-1 characters stand for themselves, the other bytes in order for the characters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes after a token's end that suffice to fix it.

    What follows can move a boundary only by a merge, and that shows further to the left only by a
    later merge whose right part is the left part of the one before, or its result. The longest such
    chain, by the bytes that it moves to the left, bounds the reach of any change; the longest token
    covers the first merge of the chain.
    """
    reach: dict[bytes, int] = {}  # right part -> longest reach of a chain that begins with it, over later merges
    most = 0
    for left, right in reversed(merges):
        here = len(left) + max(reach.get(left, 0), reach.get(left + right, 0))
        reach[right] = max(reach.get(right, 0), here)
        most = max(most, here)
    return most + max((len(a) + len(b) for a, b in merges), default=1)


class Vocabulary:
    """Merges, ids and special tokens of a ``tokenizers`` JSON file with a byte-level BPE model."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        raw = lambda token: bytes(alphabet[c] for c in token)
        ids = {raw(t): i for t, i in spec["model"]["vocab"].items() if all(c in alphabet for c in t)}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.merges = [(raw(a), raw(b)) for a, b in merges]
        self.base = max(ids.values()) + 1
        self.ranks = {ids[a] * self.base + ids[b]: rank for rank, (a, b) in enumerate(self.merges)}
        self.made = [ids[a + b] for a, b in self.merges]  # by rank
        self.byte_ids = [ids.get(bytes([b])) for b in range(256)]
        self.lookahead = sufficient_lookahead(self.merges)
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        n = max([*ids.values(), *self.specials.values()]) + 1
        self.bytes_of = [b""] * n
        for token, i in ids.items():
            self.bytes_of[i] = token
        for token, i in self.specials.items():
            self.bytes_of[i] = token.encode()

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of a whole piece: the pair of the lowest rank first, the leftmost of equals.

        Short pieces look for it anew each time; longer ones keep a heap and a linked list."""
        ids = [self.byte_ids[b] for b in piece]
        if len(ids) > 48:
            return self._merge_long(ids)
        get, base, none = self.ranks.get, self.base, len(self.made)
        ranks = [get(a * base + b, none) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            ids[at] = new = self.made[best]
            del ids[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = get(new * base + ids[at + 1], none)
            if at:
                ranks[at - 1] = get(ids[at - 1] * base + new, none)
        return ids

    def _merge_long(self, ids: list) -> list[int]:
        n, get, base = len(ids), self.ranks.get, self.base
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            rank = get(ids[i] * base + ids[i + 1])
            if rank is not None:
                heap.append((rank, i, ids[i], ids[i + 1]))
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = right[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = self.made[rank], None
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            for p, q in ((left[i], i), (i, right[i])):
                if p >= 0 and q < n:
                    rank = get(ids[p] * base + ids[q])
                    if rank is not None:
                        heapq.heappush(heap, (rank, p, ids[p], ids[q]))
        return [i for i in ids if i is not None]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Merger:
    """Tokens of one piece whose bytes come in parts; holds about two windows of lookahead."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.held = vocab, b""

    def feed(self, part: bytes) -> list[int]:
        """Ids that no continuation of the piece can change."""
        self.held += part
        keep = self.vocab.lookahead
        if len(self.held) < 4 * keep:
            return []
        ids = self.vocab.merge(self.held)
        size, n = 0, 0
        for i in ids:
            if size + len(self.vocab.bytes_of[i]) > len(self.held) - keep:
                break
            size += len(self.vocab.bytes_of[i])
            n += 1
        self.held = self.held[size:]
        return ids[:n]

    def finish(self) -> list[int]:
        ids, self.held = self.vocab.merge(self.held), b""
        return ids


class _Memory(dict):
    """Little-endian ids of a piece; remembers a bounded number of pieces."""

    def __init__(self, vocab: Vocabulary):
        super().__init__()
        self.vocab = vocab

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.vocab.merge(piece.encode()), "<u4").tobytes()
        if len(piece) <= PIECE and len(self) < MEMORY:
            self[piece] = ids
        return ids


@lru_cache(maxsize=2)
def memory(path: str) -> _Memory:
    """One for each worker process: later tasks find the pieces of earlier ones."""
    return _Memory(vocabulary(path))


class Encoder:
    """feed() text in parts of any size, then finish(); both yield little-endian 32-bit ids as bytes.

    Holds at most about two chunks of text, whatever the length of the stream or of a piece."""

    def __init__(self, vocab: Vocabulary, memory: _Memory | None = None):
        self.vocab = vocab
        self.memory = _Memory(vocab) if memory is None else memory
        self.text = ""  # what may still change
        self.run: str | None = None  # class of the open run at the start of text
        self.merger = Merger(vocab)
        self.special = regex.compile("|".join(map(regex.escape, vocab.specials))) if vocab.specials else None

    def feed(self, part: str) -> Iterator[bytes]:
        for at in range(0, len(part), CHUNK):
            yield from self._specials(self.text + part[at:at + CHUNK], False)

    def finish(self, part: str = "") -> Iterator[bytes]:
        """The last part, at most CHUNK characters, and what was held."""
        yield from self._specials(self.text + part, True)

    def encode(self, text: str) -> Iterator[bytes]:
        """A whole text, streamed."""
        last = max(0, (len(text) - 1) // CHUNK * CHUNK)
        yield from self.feed(text[:last])
        yield from self.finish(text[last:])

    def _specials(self, text: str, last: bool) -> Iterator[bytes]:
        self.text = ""
        if self.special is not None:
            while m := self.special.search(text):
                yield from self._pieces(text[:m.start()], True)
                yield np.array([self.vocab.specials[m[0]]], "<u4").tobytes()
                text = text[m.end():]
        held = 0
        if not last:  # the start of a special token may stand at the end
            for token in self.vocab.specials:
                for n in range(min(len(token) - 1, len(text)), held, -1):
                    if token.startswith(text[len(text) - n:]):
                        held = n
                        break
        yield from self._pieces(text[:len(text) - held], last)
        self.text += text[len(text) - held:]

    def _pieces(self, text: str, last: bool) -> Iterator[bytes]:
        """Emit the settled pieces of text; leave the rest in self.text, nothing if it is the last."""
        if self.run is not None:
            m = _RUNS[self.run].match(text)
            end = m.end() if m else 0
            if end == len(text) and not last:
                settled = max(0, end - SETTLE)
                yield self._ids(self.merger.feed(text[:settled].encode()))
                self.text = text[settled:]
                return
            if self.run == "S" and end < len(text):
                end -= 1  # the last white space before another character is a piece of its own
            yield self._ids(self.merger.feed(text[:max(0, end)].encode()))
            yield self._ids(self.merger.finish())
            text, self.run = text[max(0, end):], None
        if last:
            yield b"".join(map(self.memory.__getitem__, _SPLIT.findall(text)))
            return
        pieces = _SPLIT.findall(text)  # they tile the text
        open_at = len(text)
        while pieces and open_at > len(text) - SETTLE:
            open_at -= len(pieces.pop())
        yield b"".join(map(self.memory.__getitem__, pieces))
        text = text[open_at:]
        if len(text) >= CHUNK and (m := _SPLIT.match(text)) and m.end() >= len(text) - SETTLE:
            lead = text[1] if text[0] == " " and not text[1].isspace() else text[0]
            self.run = next(k for k, r in _RUNS.items() if r.match(lead))
            yield self._ids(self.merger.feed(text[:len(text) - SETTLE].encode()))
            text = text[len(text) - SETTLE:]
        self.text = text

    @staticmethod
    def _ids(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()


class Decoder:
    """Ids in, text out: an incremental UTF-8 state machine keeps the bytes of an unfinished character.
    Bytes that are no UTF-8 become U+FFFD, one for each maximal part of a character."""

    def __init__(self, vocab: Vocabulary):
        self.table = vocab.bytes_of
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(map(self.table.__getitem__, ids)))

    def finish(self) -> str:
        return self.state.decode(b"", True)


def _transcode(path: str, keep: list[str], want: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, known = vocabulary(path), memory(path)
        for whole in batches:
            for lo, hi in W.slices(whole.column("text")):
                batch = whole.slice(lo, hi - lo)
                counts, digests, ids, texts = [], [], [], []
                for text in batch.column("text").to_pylist():
                    digest, decoder, n, parts, out = hashlib.sha256(), Decoder(vocab), 0, [], []
                    for part in Encoder(vocab, known).encode(text or ""):
                        numbers = np.frombuffer(part, "<u4")
                        n += len(numbers)
                        digest.update(part)
                        if "ids" in want:
                            parts.append(numbers)
                        if "decoded" in want:
                            out.append(decoder.feed(numbers.tolist()))
                    counts.append(n)
                    digests.append(digest.hexdigest())
                    ids.append(np.concatenate(parts) if parts else np.zeros(0, "<u4"))
                    texts.append("".join([*out, decoder.finish()]))
                made = {"n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(digests)}
                if "ids" in want:
                    made["ids"] = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]), pa.int32()),
                                                           pa.array(np.concatenate(ids).astype(np.int32)))
                if "decoded" in want:
                    made["decoded"] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *made.values()], names=[*keep, *made])
    return run


def encode(docs: DataFrame, path: str, ids: bool = True, decoded: bool = False) -> DataFrame:
    """``docs`` (a string column text; other columns pass through, but for the names below) with
    n_tokens long; ids_sha256 string, the SHA-256 of the ids as little-endian 32-bit integers;
    ids array<int>, if asked for; decoded string, the text decoded from the ids, if asked for.

    ``path`` is a tokenizers JSON file that every executor can read. Special tokens in a text are
    recognised, none is added. A null or empty text has no tokens and decodes to "".
    """
    want = ["n_tokens", "ids_sha256", *["ids"] * ids, *["decoded"] * decoded]
    base = docs.drop("n_tokens", "ids_sha256", "ids", "decoded").withColumn("text", F.col("text").cast("string"))
    kinds = {"n_tokens": "long", "ids_sha256": "string", "ids": "array<int>", "decoded": "string"}
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields] + [f"{c} {kinds[c]}" for c in want]
    return base.mapInArrow(_transcode(path, base.columns, want), ", ".join(schema))


def decode(frame: DataFrame, path: str, ids: str = "ids", to: str = "text") -> DataFrame:
    """``frame`` with the text of the array<int> column ``ids``; null ids give null."""
    @F.arrow_udf("string")
    def texts(column: pa.Array) -> pa.Array:
        vocab = vocabulary(path)
        out = []
        for numbers in column:
            if not numbers.is_valid:
                out.append(None)
                continue
            decoder, known = Decoder(vocab), numbers.values
            parts = [decoder.feed(known.slice(at, CHUNK).to_pylist()) for at in range(0, len(known), CHUNK)]
            out.append("".join([*parts, decoder.finish()]))
        return pa.array(out, pa.string())

    return frame.withColumn(to, texts(F.col(ids)))
