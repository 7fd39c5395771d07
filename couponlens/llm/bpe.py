"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

A word is cut by the tokenizer's own splitting rule, found on whole batches at once. Each different word is encoded
once: an Aho-Corasick automaton over the vocabulary gives the longest token at every place; tokens are laid down from
the left, and a token may follow another only if merging the two texts from scratch would leave exactly these two
(`_Merges.fit`, remembered per pair). Where no token fits, the last one is taken back. Adjacent pairs that all fit make
the one sequence that the merges produce, so the result is exact, and each place is given up at most once.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from couponlens.llm.common import RunHash, rows, text_chunks, texts_only, trim

_FINAL = 0x1000  # added to a word's last symbol where the vocabulary marks word ends
_END, _SPECIAL = "\ud800", 0xD801  # lone surrogates: they cannot occur in a text
_PUNCT, _LETTER, _NUMBER, _WHITE, _STOP, _UNKNOWN = range(6)
_CACHED = 1_000_000  # words that a worker remembers before it starts anew
_PAIRS = 300_000  # pairs of tokens that it remembers
_CHUNK = 1_000_000  # characters that are encoded at once


def vocabulary(path: str) -> bytes:
    """The tokenizer file as sent to the tasks, compressed (some 0.5 MB, a fixed size)."""
    with open(path, "rb") as f:
        return zlib.compress(f.read())


def _byte_symbols() -> list[str]:
    """The printable symbol that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in out:
            out[b] = chr(extra)
            extra += 1
    return [out[b] for b in range(256)]


class _Merges:
    def __init__(self, vocab: dict[str, int], merges: list, suffix: str) -> None:
        def symbols(token: str) -> str:
            if suffix and token.endswith(suffix):
                body = token[: -len(suffix)]
                return body[:-1] + chr(ord(body[-1]) + _FINAL)
            return token

        self.texts = {symbols(t): i for t, i in vocab.items()}
        size = max(vocab.values()) + 1
        self.length, self.born = [0] * size, [-1] * size
        self.left, self.right, self.rank = [-1] * size, [-1] * size, {}
        for t, i in self.texts.items():
            self.length[i] = len(t)
        for at, pair in enumerate(merges):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            i, j, made = vocab[a], vocab[b], vocab[a + b]
            self.rank[i << 20 | j] = at
            if self.born[made] < 0:
                self.born[made], self.left[made], self.right[made] = at, i, j
        self.known: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for t, i in self.texts.items():
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        self.shorter = [-1] * size  # the longest token that is a proper prefix
        for t, i in self.texts.items():
            for n in range(len(t) - 1, 0, -1):
                if (p := self.texts.get(t[:n])) is not None:
                    self.shorter[i] = p
                    break

    def fit(self, a: int, b: int) -> bool:
        """Whether merging the texts of two tokens, one after the other, leaves these two tokens.

        Follows the pieces at the border back in time. A merge across it happens if its rank comes before the merges
        that use up the left or the right piece; at the same rank, the merge further left comes first.
        """
        x, y, x_ends, y_ends = a, b, 1 << 60, 1 << 60
        born, rank = self.born, self.rank
        while True:
            r = rank.get(x << 20 | y)
            if r is not None and r < x_ends and r <= y_ends:
                return False
            bx, by = born[x], born[y]
            if bx < 0 and by < 0:
                return True
            if bx > by:
                x_ends, x = bx, self.right[x]
            else:
                y_ends, y = by, self.left[y]

    def encode(self, word: str) -> list[int]:
        whole = self.texts.get(word)
        if whole is not None:
            return [whole]
        n, length, shorter, known = len(word), self.length, self.shorter, self.known
        longest = [0] * n
        for end, token in self.automaton.iter(word):
            longest[end + 1 - length[token]] = token  # ends ascend, so the longest stays
        out: list[int] = []
        given_up = set()
        at, token, last = 0, longest[0], -1
        while True:
            to = at + length[token]
            ok = to not in given_up
            if ok and last >= 0:
                key = last << 20 | token
                ok = known.get(key)
                if ok is None:
                    if len(known) >= _PAIRS:
                        known.clear()
                    ok = known[key] = self.fit(last, token)
            if ok:
                out.append(token)
                if to == n:
                    return out
                at, last = to, token
                token = longest[at]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                given_up.add(at)
                token = out.pop()
                at -= length[token]
                last = out[-1] if out else -1


class Encoder:
    """Encodes and decodes lists of texts with one tokenizer file; one per Python worker, see `encoder`."""

    def __init__(self, packed: bytes) -> None:
        self.file = zlib.decompress(packed)
        spec = json.loads(self.file)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.lower = self.words_only = bool(self.suffix)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if model.get("byte_fallback") or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("only plain byte-level merges are supported")
        self.merges = _Merges({t: i for t, i in model["vocab"].items() if t not in self.special}, model["merges"], self.suffix)
        self.byte_to_symbol = dict(enumerate(_byte_symbols()))
        size = max([*model["vocab"].values(), *self.special.values()]) + 1
        self.size = size
        names = [""] * size
        for t, i in [*model["vocab"].items(), *self.special.items()]:
            names[i] = t
        self.spaced = spec.get("decoder") is None  # without a decoder, tokens are joined by spaces
        if self.spaced:
            pieces = [(t + " ").encode() for t in names]
        else:
            back = {c: b for b, c in self.byte_to_symbol.items()}
            pieces = [bytes(back[c] for c in t) if t not in self.special else t.encode() for t in names]
        self.piece_ends = np.cumsum([len(p) for p in pieces])
        self.piece_len = np.array([len(p) for p in pieces])
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.classes = self._classes()
        self.hash = RunHash()
        self._forget()

    @staticmethod
    def _classes() -> np.ndarray:
        kinds = {"L": _LETTER, "N": _NUMBER, "Z": _WHITE}
        named = (unicodedata.category(chr(c)) for c in range(0x110000))
        out = np.array([_UNKNOWN if c == "Cn" else kinds.get(c[0], _PUNCT) for c in named], np.uint8)
        out[[*range(9, 14), 0x85]] = _WHITE
        out[0xD800:0xE000] = _STOP
        return out

    def _forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.pool, self.used = np.zeros(1 << 16, np.int32), 0
        self.slot_at, self.slot_len = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _word(self, word: str) -> list[int]:
        text = word.encode().decode("latin-1").translate(self.byte_to_symbol)
        return self.merges.encode(text[:-1] + chr(ord(text[-1]) + _FINAL) if self.suffix else text)

    def _remember(self, keys: list[int], found: list[list[int]]) -> np.ndarray:
        """Slots of new words, whose ids are laid into the pool in one piece."""
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        first, upto = len(self.slots), self.used + np.cumsum(sizes)
        slots = np.arange(first, first + len(keys))
        self.slots.update(zip(keys, slots.tolist()))
        while first + len(keys) > len(self.slot_at):
            self.slot_at, self.slot_len = (np.concatenate([x, np.zeros_like(x)]) for x in (self.slot_at, self.slot_len))
        while upto[-1] > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : upto[-1]] = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
        self.slot_at[slots], self.slot_len[slots] = upto - sizes, sizes
        self.used = int(upto[-1])
        return slots

    def _starts(self, codes: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last-plus-one places of the words of the joined texts; the last code is a stop."""
        before = np.concatenate([[_STOP], kind[:-1]]).astype(np.uint8)
        start = ((kind != before) & (kind != _WHITE)) | (kind == _NUMBER) if self.words_only else kind != before
        start |= kind == _STOP
        if not self.words_only:
            last = (kind == _WHITE) & (np.concatenate([kind[1:], [_STOP]]) != _WHITE)
            last &= np.concatenate([kind[1:], [_STOP]]) != _STOP
            at = np.nonzero(last)[0]
            start[at] = True
            start[at[codes[at] == 32] + 1] = False
        mark = np.nonzero((codes == 39) & (before != _PUNCT))[0]
        if not self.words_only and len(mark):
            mark = mark[(mark == 0) | (codes[mark - 1] != 32)]
        if len(mark):
            padded = np.concatenate([codes[-1:], codes, codes[-1:], codes[-1:]])  # place i of the text is i + 1 here
            one, two = padded[mark + 2], padded[mark + 3]
            size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 2, 0)
            size[((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)] = 3
            mark, size = mark[size > 0], size[size > 0]
            start[mark] = True
            start[mark + 1] = False
            after = mark + size
            start[after[kind[after] == _LETTER]] = True
        if self.words_only:
            edge = np.nonzero(start | (kind == _WHITE))[0]
        else:
            edge = np.nonzero(start)[0]
        ends = np.concatenate([edge[1:], [len(codes)]])
        keep = start[edge] & ((kind[edge] != _STOP) | (codes[edge] != ord(_END)))
        return edge[keep], ends[keep]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's ids begin (one place more than texts).

        Texts with characters that this Python's Unicode tables do not know yet (a handful of recent scripts) go to the
        tokenizers library itself, whose tables may be newer.
        """
        if not texts:
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        joined = _END.join(texts) + _END
        if not joined.isascii():
            codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
            if len(odd := np.nonzero(self.classes[codes] == _UNKNOWN)[0]):
                odd = np.unique(np.searchsorted(np.nonzero(codes == ord(_END))[0], odd))
                library = Tokenizer.from_buffer(self.file)
                library.no_truncation()
                library.no_padding()
                ids, begins = self.encode([*map({i: "" for i in odd}.get, range(len(texts)), texts)])
                parts = np.split(ids, begins[1:-1])
                for i in odd:
                    parts[i] = np.array(library.encode(texts[i], add_special_tokens=False).ids, np.int32)
                return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        for k, name in enumerate(self.special):
            if name in joined:
                joined = joined.replace(name, chr(_SPECIAL + k))
        if self.lower:
            if not joined.isascii() and not unicodedata.is_normalized("NFC", joined):
                joined = unicodedata.normalize("NFC", joined)
            joined = joined.replace("Σ", "σ").lower()
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        starts, ends = self._starts(codes, self.classes[codes])
        stops = np.nonzero(codes == ord(_END))[0]
        keys = self.hash.runs(self.hash.sums(codes), starts, ends)
        which, different = pd.factorize(keys)
        if len(self.slots) + len(different) > _CACHED:
            self._forget()
        slots = np.fromiter(map(self.slots.get, different.tolist(), repeat(-1)), np.int64, len(different))
        new = np.nonzero(slots < 0)[0]
        if len(new):
            first = np.full(len(different), -1)
            first[which[::-1]] = np.arange(len(which))[::-1]
            special = [*self.special.values()]
            words = [joined[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())]
            found = [[special[ord(x) - _SPECIAL]] if "\ud801" <= x[0] <= "\udfff" else self._word(x) for x in words]
            slots[new] = self._remember(different[new].tolist(), found)
        slot = slots[which]
        size = self.slot_len[slot]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.pool[np.repeat(self.slot_at[slot] - upto[:-1], size) + np.arange(upto[-1])]
        begins = np.concatenate([[0], upto[np.searchsorted(starts, stops)]])
        return ids, begins

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids in UTF-8, special tokens written out."""
        size = self.piece_len[ids]
        upto = np.cumsum(size)
        if not len(ids):
            return b""
        raw = self.piece_bytes[np.repeat(self.piece_ends[ids] - upto, size) + np.arange(upto[-1])].tobytes()
        return raw[:-1] if self.spaced else raw.decode("utf-8", "replace").encode()


_ENCODERS: dict[bytes, Encoder] = {}


def encoder(packed: bytes) -> Encoder:
    """The worker's own encoder; its tables and remembered words serve all tasks of the worker."""
    key = hashlib.sha1(packed).digest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(packed)
    return _ENCODERS[key]


def drop_encoders() -> None:
    """Gives up the worker's encoders, where the tasks that follow need the memory more than the time to load them again."""
    _ENCODERS.clear()
    trim()


def encoded(batches: Iterator[pa.RecordBatch], packed: bytes) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """For chunks of the rows (doc_id, text): their keys, the ids of their texts, where each text's ids begin."""
    tool = encoder(packed)
    for keys, texts in text_chunks(batches, _CHUNK):
        yield keys, *tool.encode(texts)


def encode_tokens(docs: DataFrame, vocab_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and its ``ids`` (array<int>). A null text counts as empty and has no ids;
    repeated rows are encoded each; other columns are ignored; an empty table gives no rows."""
    packed = vocabulary(vocab_path)

    def run(batches):
        for keys, ids, begins in encoded(batches, packed):
            yield rows(doc_id=keys, ids=pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids, pa.int32())))

    return texts_only(docs, key, text).mapInArrow(run, "doc_id long, ids array<int>")


def decode_tokens(tokens: DataFrame, vocab_path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """One row per document: ``doc_id`` and the ``text`` of its ids. No ids, or null, give an empty text."""
    packed = vocabulary(vocab_path)

    def run(batches):
        tool = encoder(packed)
        for batch in batches:
            texts = [tool.decode(np.array(x or [], np.int64)).decode() for x in batch.column(1).to_pylist()]
            yield rows(doc_id=batch.column(0), text=pa.array(texts, pa.string()))

    return tokens.select(F.col(key).cast("long").alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(run, "doc_id long, text string")


def token_digest(docs: DataFrame, vocab_path: str) -> DataFrame:
    """Number of ids, and the SHA-256 of the ids (little-endian, 32 bits each) and of their decoded text; one row per
    document, in one pass. Edge cases as in `encode_tokens`."""
    packed = vocabulary(vocab_path)

    def run(batches):
        tool = encoder(packed)
        for keys, ids, begins in encoded(batches, packed):
            spans = list(zip(begins[:-1].tolist(), begins[1:].tolist()))
            raw = ids.astype("<u4")
            yield rows(
                doc_id=keys, n_tokens=np.diff(begins),
                ids_sha256=[hashlib.sha256(raw[a:b]).hexdigest() for a, b in spans],
                decoded_sha256=[hashlib.sha256(tool.decode(ids[a:b])).hexdigest() for a, b in spans])

    return texts_only(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
