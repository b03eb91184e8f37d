"""BPE encoding by prefix-sharing trie traversal, and decoding.

The words of a batch that are not yet known are inserted into a trie of byte symbols. A depth-first walk gives
every node its last-token state: the last token of the encoding of the node's prefix. It is the one vocabulary
token that ends the prefix, encodes to itself, and stays apart from the last token of the prefix before it when the
two are merged by rank; so a prefix that many words share is encoded once. A word's ids follow the states back from
its last node. Works on any file of the public library's format with ranked merges, a word-end suffix and a
byte-level alphabet; nothing is trained.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

#: The splitting pattern of the vocabulary file, as its text states it.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words a worker keeps encoded; the store starts anew beyond it (a memory bound, not a limit on words).
KNOWN_WORDS = 600_000
#: Characters of texts whose new words share a trie; longer texts are encoded in stretches of this length.
GROUP_CHARS = 1_000_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable Latin-1, else the next from U+0100."""
    out, spare = [], 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(256 + spare))
            spare += 1
    return out


class WordEncoder:
    """Ids of words (byte-symbol strings) by trie traversal over one vocabulary."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.vocab, self.suffix = vocab, suffix
        self.ranks = {pair: i for i, pair in enumerate(merges)}
        inner = {t: i for t, i in vocab.items() if not t.endswith(suffix)}
        final = {t[:-len(suffix)]: i for t, i in vocab.items() if t.endswith(suffix) and len(t) > len(suffix)}
        self.symbols = {i: self._symbols(t) for t, i in vocab.items()}
        self.size = {i: len(s) for i, s in self.symbols.items()}
        self.apart: dict[int, bool] = {}
        self._suffixes(inner, final)

    def _suffixes(self, inner: dict[str, int], final: dict[str, int]) -> None:
        """Automaton over the tokens' texts: its state after a prefix lists the tokens that end it, longest first, both
        those inside words (``ends``) and those at word ends (``finals``)."""
        self.step, self.ends, self.finals, self.back = [{}], [()], [()], [0]
        for tokens, out in ((inner, self.ends), (final, self.finals)):
            for text, token in tokens.items():
                at = 0
                for c in text:
                    if c not in self.step[at]:
                        self.step[at][c] = len(self.step)
                        self.step.append({})
                        self.back.append(0)
                        self.ends.append(())
                        self.finals.append(())
                    at = self.step[at][c]
                out[at] = (token,)
        tree = [dict(x) for x in self.step]
        level = list(tree[0].values())
        while level:  # breadth first: shorter suffixes are complete before longer ones need them
            below = []
            for at in level:
                shorter = self.back[at]
                self.ends[at] += self.ends[shorter]
                self.finals[at] += self.finals[shorter]
                for c, child in tree[at].items():
                    self.back[child] = self._next(shorter, c) if at else 0
                    below.append(child)
            level = below

    def _next(self, state: int, c: str) -> int:
        """State after one more character: that of the longest suffix that any token starts with."""
        at = self.step[state].get(c)
        if at is None:
            at = self._next(self.back[state], c) if state else 0
            self.step[state][c] = at
        return at

    def _symbols(self, token: str) -> list[str]:
        if token.endswith(self.suffix) and len(token) > len(self.suffix):
            body = token[:-len(self.suffix)]
            return [*body[:-1], body[-1] + self.suffix]
        return list(token)

    def merged(self, parts: list[str]) -> list[str]:
        """``parts`` merged lowest rank first, leftmost first."""
        parts = list(parts)
        while len(parts) > 1:
            rank, i = min((self.ranks.get(p, len(self.ranks)), i) for i, p in enumerate(zip(parts, parts[1:])))
            if rank == len(self.ranks):
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` can follow ``before`` (-1: nothing): merging both symbol by symbol gives the two again."""
        parts = (self.symbols[before] if before >= 0 else []) + self.symbols[token]
        known = [self.vocab.get(p) for p in self.merged(parts)] == ([before, token] if before >= 0 else [token])
        self.apart[before << 20 | token] = known
        return known

    def _last(self, last: list[int], tokens: tuple[int, ...]) -> int:
        """The last token of a prefix: the one of ``tokens``, those that end it, that fits the prefix before it."""
        n, apart, size = len(last), self.apart, self.size
        for token in tokens:
            before = last[n - size[token]]
            known = apart.get(before << 20 | token)
            if known or known is None and self.fits(before, token):
                return token
        raise ValueError("the vocabulary has no symbol for a byte")

    def encode(self, words: set[str]) -> dict[str, bytes]:
        """Ids of each distinct word, as unsigned 32-bit integers.

        Sorted words are their trie laid out depth first: what a word shares with the one before it is the path down
        to the node where they part, and the states along it are kept; only the nodes below are new.
        """
        out = {"": b""}
        step, size, ends = self.step, self.size, self.ends
        # by depth on the path: the automaton's state, and the last token (-1: of no prefix) of prefixes above the word
        states, last, before = [0], [-1], ""
        for word in sorted(words):
            shared = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            del states[shared + 1:], last[shared + 1:]
            for c in word[shared:]:
                if len(last) < len(states):
                    last.append(self._last(last, ends[states[-1]]))
                state = step[states[-1]].get(c)
                states.append(self._next(states[-1], c) if state is None else state)
            if word:
                ids, at = [self._last(last, self.finals[states[-1]])], len(word)
                while at := at - size[ids[-1]]:
                    ids.append(last[at])
                ids.reverse()
                out[word] = array("I", ids).tobytes()
            before = word
        return out


class Codec:
    """Encoder and decoder of one vocabulary file; holds the words a worker has met."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.words = WordEncoder(model["vocab"], merges, model["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        texts = {i: t for t, i in (model["vocab"] | self.special).items()}
        self.spelt = pa.array([texts.get(i) for i in range(max(texts) + 1)])
        self.known: dict[str, bytes] = {}
        self.symbol_of = dict(enumerate(byte_symbols()))
        self.cut = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.split, self.blank = regex.compile(SPLIT), regex.compile(r"(?<=[a-z0-9 ])[ \n](?=[a-z0-9])")
        # below U+0250 the character tables of the libraries at hand agree; other texts use the vocabulary library's
        self.plain = regex.compile(r"[\x00-ɏ]*")
        from tokenizers import Tokenizer
        own = Tokenizer.from_file(path)
        self.normalise, self.pieces_of = own.normalizer.normalize_str, own.pre_tokenizer.pre_tokenize_str
        self.back = {s: b for b, s in self.symbol_of.items()}

    def pieces(self, text: str) -> list[str]:
        """Words of a text without special tokens."""
        if self.plain.fullmatch(text):
            return self.split.findall(unicodedata.normalize("NFC", text).lower())
        back = self.back
        return [bytes(back[s] for s in symbols).decode("utf-8") for symbols, _ in self.pieces_of(self.normalise(text))]

    def _learn(self, words: set[str]) -> None:
        new = words.difference(self.known)
        if new:
            if len(self.known) + len(new) > KNOWN_WORDS:
                self.known, new = {}, words
            spelt = {w: w.encode("utf-8").decode("latin-1").translate(self.symbol_of) for w in new}
            ids = self.words.encode(set(spelt.values()))
            self.known.update((w, ids[s]) for w, s in spelt.items())

    def _runs(self, text: str) -> Iterator[list[str] | int]:
        """Words of the parts between special tokens, and ids of those, in order."""
        at = 0
        for m in chain(self.cut.finditer(text), [None]):
            for part in self._parts(text[at:m.start() if m else len(text)]):
                yield self.pieces(part)
            if m:
                yield self.special[m.group()]
                at = m.end()

    def _parts(self, text: str) -> Iterator[str]:
        """The text in stretches of about ``GROUP_CHARS`` cut before a blank, where words never meet."""
        at = 0
        while len(text) - at > GROUP_CHARS and (m := self.blank.search(text, at + GROUP_CHARS)):
            yield text[at:m.start()]
            at = m.start()
        yield text[at:] if at else text

    def _ids(self, runs) -> np.ndarray:
        # a run may renew the store of known words as it is read
        parts = (array("I", [run]).tobytes() if isinstance(run, int) else b"".join(map(self.known.__getitem__, run)) for run in runs)
        return np.frombuffer(b"".join(parts), np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. The unknown words of texts up to ``GROUP_CHARS`` together share one trie; a longer text
        is encoded stretch by stretch."""
        out, group, size = [], [], 0
        for text in chain(texts, [None]):
            if group and (text is None or size + len(text) > GROUP_CHARS):
                runs = [list(self._runs(t)) for t in group]
                self._learn(set().union(*(run for r in runs for run in r if not isinstance(run, int))))
                out += [self._ids(r) for r in runs]
                group, size = [], 0
            if text is None:
                break
            if len(text) > GROUP_CHARS:
                out.append(self._ids(map(self._learned, self._runs(text))))
            else:
                group.append(text)
                size += len(text)
        return out

    def _learned(self, run: list[str] | int) -> list[str] | int:
        if not isinstance(run, int):
            self._learn(set(run))
        return run

    def decode(self, ids: pa.ListArray) -> pa.StringArray:
        """Token texts of each list joined by one space, special ones too; unknown ids are left out; null: empty."""
        values, offsets = ids.flatten(), np.concatenate([[0], np.cumsum(np.nan_to_num(np.asarray(pc.list_value_length(ids)).astype(float)))]).astype(np.int64)
        known = pc.and_(pc.greater_equal(values, 0), pc.less(values, len(self.spelt)))
        known = np.asarray(pc.and_(known, pc.is_valid(self.spelt.take(pc.if_else(known, values, 0)))).fill_null(False), dtype=bool) if len(values) else np.zeros(0, bool)
        kept = np.concatenate([[0], np.cumsum(known)])[offsets]
        texts = self.spelt.take(values.filter(pa.array(known)))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(kept, pa.int32()), texts), " ")


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, the columns of ``keep`` and ``ids`` (array of int). A map without shuffle.

    Null text counts as empty and has no ids; special tokens' texts inside a text become their ids; texts of any
    length are encoded whole, in slices of words; repeated rows are encoded alike; no rows give no rows; further
    columns are ignored, whatever their names. ``path`` names the vocabulary file, present on every executor.
    """
    path = path or vocabulary_path()
    ship(docs.sparkSession)
    out = [id_col, *keep]
    inner = [f"c{i}" for i in range(len(out))]
    narrow = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), *[F.col(c).alias(n) for c, n in zip(out, inner)])
    kinds = [f"{n} {narrow.schema[n].dataType.simpleString()}" for n in inner]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = c.encode(part.column(0).to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(rows).view(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], ids], names=[*inner, "ids"])

    return narrow.mapInArrow(run, ", ".join([*kinds, "ids array<int>"])).toDF(*out, "ids")


def decode(encoded: DataFrame, path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: id and ``decoded``, the text of its ids (null or no ids: empty). A map without shuffle."""
    path = path or vocabulary_path()
    ship(encoded.sparkSession)
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), codec(path).decode(part.column(1))], names=["id", "decoded"])

    return encoded.select(id_col, ids_col).mapInArrow(run, f"id {kind}, decoded string").withColumnRenamed("id", id_col)
