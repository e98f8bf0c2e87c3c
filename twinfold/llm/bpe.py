"""Byte-pair encoding by a tokenization automaton, and decoding by its arc labels.

The automaton reads tokens: a sequence of tokens is accepted when it is the encoding of its text. It is
compiled from the merges in their order. At first every byte may follow every byte. The gadget of merge
(a, b) -> c, the k-th, does three things: the state that a leads to loses its arc b; every state without
an arc a gets none for c, all others do; and c leads to a copy of the state of b as it is just then. A
copied state is stored as a reference with its time, (b, k), and an arc's inheritance as (a, k), so that
each gadget takes constant time and room; the written-out table would have a few hundred million arcs.
The lookup of one transition follows these references, and transitions that were looked up stay in a
table. Since the automaton is deterministic and unambiguous, a word has exactly one accepted
sequence, and each of its prefixes as well: encoding keeps the last token of each prefix and moves on by
transitions from there, in time linear in the word.

Texts are cut into words by the kinds of their characters, a slice of many texts at once in numpy; Arrow numbers
the distinct words of a slice, and only those are looked up or encoded one by one.

Decoding emits the labels (byte strings) of the arcs that the ids name, and reads them as UTF-8.

Cases: null counts as empty text, which has no tokens; a text may have any length: it is taken word by
word; repeated rows are encoded each; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.llm.shared import kept_tables

#: The split before the merges that byte-level vocabularies of this kind share.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Transitions, and words with their encodings in one generation of two, that a worker keeps.
TABLE_LIMIT, WORD_LIMIT = 300_000, 150_000
#: Characters that a worker cuts and encodes at once, and after which it hands a batch of rows on.
HAND_ON = 1_000_000
NEVER = 1 << 60

#: Bytes of a place by which the longest label that may begin there is known.
HEAD = 4
#: Kinds of characters for the split.
OTHER, LETTER, NUMBER, SPACE = range(4)


def byte_signs() -> dict[str, int]:
    """The printable sign of each byte in vocabulary files: itself where printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class TokenAutomaton:
    """labels: the bytes of each id; special: id by text, taken before the split."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], special: dict[str, int]):
        signs = byte_signs()
        as_bytes = lambda token: bytes(signs[x] for x in token)
        self.special = special
        self.labels: dict[int, bytes] = {i: t.encode() for t, i in special.items()}
        self.ids: dict[bytes, int] = {}
        self.made: dict[int, int] = {}
        self.state_of: dict[int, int] = {}
        self.arc_of: dict[int, int] = {}
        self.removed: dict[tuple[int, int], int] = {}
        self.table: dict[tuple[int, int], int] = {}
        for token, i in vocab.items():
            if token not in special:
                self.labels[i] = as_bytes(token)
        for sign, byte in signs.items():
            if sign in vocab:
                self.ids[bytes([byte])] = vocab[sign]
                self.made[vocab[sign]] = -1
        for time, (left, right) in enumerate(merges):
            self._gadget(vocab[left], vocab[right], vocab[left + right], time)
        self.reach: dict[bytes, int] = {}
        for label in self.ids:
            if len(label) >= HEAD:
                self.reach[label[:HEAD]] = max(len(label), self.reach.get(label[:HEAD], 0))
        self.table.clear()

    def _gadget(self, a: int, b: int, c: int, time: int) -> None:
        if c in self.made or a not in self.made or b not in self.made:
            return
        if self._lost(a, b) < time:
            return  # no state leads through a to b any more: the new arc would hang in the air
        self.table.clear()
        self.made[c], self.arc_of[c], self.state_of[c] = time, a, b
        self.ids[self.labels[c]] = c
        self.removed[a, b] = time

    def _lost(self, p: int, x: int) -> int:
        """The time at which the state of p lost, or came without, its arc x."""
        found = self.table.get((p, x))
        if found is not None:
            return found
        steps, at = [], (p, x)
        while True:  # down the references; times are folded on the way back
            steps.append(at)
            l, r = at
            if self.made[l] < 0 and self.made[r] < 0 or at in self.table:
                break
            at = (l, self.arc_of[r]) if self.made[r] >= self.made[l] and self.made[r] >= 0 else (self.state_of[l], r)
        below = self.table.get(steps[-1], self.removed.get(steps[-1], NEVER))
        self.table[steps[-1]] = below
        for l, r in reversed(steps[:-1]):
            if self.made[r] >= self.made[l]:
                inherited = self.made[r] if below <= self.made[r] else NEVER
            else:
                inherited = self.made[l] if below < self.made[l] else NEVER
            below = min(self.removed.get((l, r), NEVER), inherited)
            self.table[l, r] = below
        return below

    def encode_word(self, word: bytes) -> list[int]:
        """The accepted tokens of the word, by transitions from its start, longest labels first.

        A place that was reached and can't be left is dead for good, since the tokens up to any place
        are unique; so no place is left twice, and the time stays linear in the word.
        """
        known, table, reach, n = self.ids.get, self.table, self.reach.get, len(word)
        if (whole := known(word)) is not None:
            return [whole]
        if len(table) > TABLE_LIMIT:
            table.clear()
        tokens: list[int] = []
        places: list[int] = []
        dead: set[int] = set()
        at, last, end = 0, -1, min(n, reach(word[:HEAD], HEAD - 1))
        while at < n:
            while end > at:
                token = known(word[at:end])
                if token is not None and end not in dead:
                    lost = NEVER if last < 0 else table.get((last, token))
                    if (self._lost(last, token) if lost is None else lost) == NEVER:
                        break
                end -= 1
            if end > at:
                tokens.append(token)
                places.append(at)
                at, last = end, token
                end += reach(word[at : at + HEAD], HEAD - 1)
                if end > n:
                    end = n
            elif tokens:  # back to the place before, and on with its shorter labels
                dead.add(at)
                tokens.pop()
                at, end, last = places.pop(), at - 1, tokens[-1] if tokens else -1
            else:
                raise ValueError("the vocabulary lacks a byte of the word")
        return tokens

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


def load_automaton(path: str) -> TokenAutomaton:
    """From a vocabulary file in the tokenizers library's JSON form (byte-level BPE)."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ", 1)) for m in spec["model"]["merges"]]
    return TokenAutomaton(spec["model"]["vocab"], merges, {t["content"]: t["id"] for t in spec.get("added_tokens", [])})


def char_kinds() -> np.ndarray:
    """The kind of each code point, as the split's classes have it."""
    import regex

    every, kinds = "".join(map(chr, range(0x110000))), np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for found in regex.finditer(pattern, every):
            kinds[found.start() : found.end()] = kind
    return kinds


class Encoder:
    """Texts to ids and back, with a table of the words met."""

    def __init__(self, automaton: TokenAutomaton):
        import regex

        self.automaton, self.words, self.older = automaton, {}, {}
        self.kinds = char_kinds()
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(automaton.special, key=len, reverse=True))) + ")") if automaton.special else None
        self.special_words = {text.encode(): array("i", [i]).tobytes() for text, i in automaton.special.items()}
        self.gap = regex.compile(r"\S(?=\s)")
        ids = range(max(automaton.labels, default=-1) + 1)
        self.labels = pa.array([automaton.labels.get(i, b"") for i in ids], pa.large_binary())
        self.decimals = pa.array([b"%d," % i for i in ids], pa.large_binary())

    def _word(self, word: bytes) -> bytes:
        """The encoding of a word, as 32-bit ids, that the newer generation lacks; a full one becomes the older."""
        found = self.older.get(word) or self.special_words.get(word)
        if found is None:
            found = array("i", self.automaton.encode_word(word)).tobytes()
        if len(word) <= 64:
            if len(self.words) >= WORD_LIMIT:
                self.words, self.older = {}, self.words
            self.words[word] = found
        return found

    def _parts(self, text: str) -> Iterator[str]:
        """The special tokens of a text and what is between them; long parts are cut where white space begins, which ends a word."""
        special = self.automaton.special
        for part in self.special.split(text) if self.special and any(s in text for s in special) else [text]:
            at = 0
            while part not in special and len(part) - at > HAND_ON and (found := self.gap.search(part, at + HAND_ON)):
                yield part[at : found.end()]
                at = found.end()
            yield part[at:]

    def _starts(self, code: np.ndarray, firsts: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Where the words of parts begin that lie one after the other: SPLIT's matches. whole: of each part, whether it is one word."""
        n, kind = len(code), self.kinds[code]
        first = np.zeros(n + 1, bool)
        first[firsts] = first[n] = True
        change = first[:n].copy()
        change[1:] |= kind[1:] != kind[:-1]
        inside = change[1:] & ~first[1:n]  # a run ends before this character, its part doesn't
        blank, start = code == 32, change.copy()
        start[1:] &= ~(inside & blank[:-1])  # a blank joins the run after it
        start[:-1] |= inside & (kind[:-1] == SPACE)  # and white space before a run leaves it its last character
        for at in np.flatnonzero(start & (code == 39)).tolist():
            two = code[at + 1 : at + 3].tolist() if not first[at + 1] else []
            two = two[:1] if len(two) == 2 and first[at + 2] else two
            tail = "".join(map(chr, two))
            length = 2 if tail[:1] in ("s", "t", "m", "d") else 3 if tail in ("re", "ve", "ll") else 0
            if length:
                start[at + 1] = False
                if at + length < n:
                    start[at + length] = True
        if whole.any():
            for at in np.flatnonzero(whole).tolist():
                start[firsts[at] + 1 : firsts[at + 1] if at + 1 < len(firsts) else n] = False
        return np.flatnonzero(start)

    def _slice(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of parts, one after the other, and where those of each begin (and the last end)."""
        parts_at = np.cumsum([0, *map(len, parts)])
        text = "".join(parts)
        if not text:
            return np.empty(0, np.int32), np.zeros(len(parts) + 1, np.int64)
        full = np.diff(parts_at) > 0
        whole = np.array([p in self.automaton.special for p in parts])
        begin = self._starts(np.frombuffer(text.encode("utf-32-le"), np.uint32), parts_at[:-1][full], whole[full])
        data = text.encode()
        at_byte = begin if len(data) == len(text) else np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)[begin]
        edges = pa.py_buffer(np.append(at_byte, len(data)).astype(np.int64))
        words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, edges, pa.py_buffer(data)]).dictionary_encode()
        _, edges, data = words.dictionary.buffers()
        edges, data = np.frombuffer(edges, np.int64)[: len(words.dictionary) + 1].tolist(), data.to_pybytes()
        packed = []
        for a, b in zip(edges, edges[1:]):
            word = data[a:b]
            packed.append(self.words.get(word) or self._word(word))  # the generation may change on the way
        taken = pa.array(packed, pa.large_binary()).take(words.indices)
        ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(begin) + 1] // 4
        return np.frombuffer(taken.buffers()[2], np.int32)[: ends[-1]], ends[np.searchsorted(begin, parts_at)]

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts, one after the other, and where those of each begin (and the last end)."""
        ids, counts = [], [np.zeros(1, np.int64)]
        parts: list[str] = []
        owned, held = [0], 0
        for text in texts:
            of_text = 0
            for part in self._parts(text):
                if parts and held + len(part) > HAND_ON:
                    found, at = self._slice(parts)
                    ids.append(found)
                    counts.append(np.diff(at))
                    parts, held = [], 0
                parts.append(part)
                held += len(part)
                of_text += 1
            owned.append(owned[-1] + of_text)
        found, at = self._slice(parts)
        ids.append(found)
        counts.append(np.diff(at))
        return np.concatenate(ids), np.cumsum(np.concatenate(counts))[owned]

    def encode(self, text: str) -> str:
        """The ids in decimal, joined by commas."""
        return ",".join(map(str, self.encode_all([text])[0].tolist()))

    def joined(self, table: pa.Array, ids: np.ndarray, at: np.ndarray) -> list[memoryview]:
        """For each text, the entries of a table (labels or decimals) that its ids name, one after the other."""
        taken = table.take(pa.array(ids))
        edges, data = np.frombuffer(taken.buffers()[1], np.int64)[at].tolist(), memoryview(taken.buffers()[2] or b"")
        return [data[a:b] for a, b in zip(edges, edges[1:])]


def worker_encoder(path: str) -> Encoder:
    """One automaton, with its tables, for all tasks of a Python worker, until another operator's tasks let it go."""
    return kept_tables(("bpe", path), lambda: Encoder(load_automaton(path)))


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per row of docs: id, n_tokens, ids_sha256, decoded_sha256, and with with_ids also ids and decoded.

    The words of a task share one table of encodings; nothing is shuffled.
    """
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(vocabulary)
        for batch in batches:
            start, held, texts = 0, 0, []
            for row, text in enumerate(batch.column("text")):
                texts.append(text.as_py() or "")
                held += len(texts[-1])
                if held < HAND_ON and row + 1 < batch.num_rows:
                    continue
                ids, at = encoder.encode_all(texts)
                hashes = [hashlib.sha256(joined[:-1]).hexdigest() for joined in encoder.joined(encoder.decimals, ids, at)]
                decoded = [str(label, "utf-8", "replace") for label in encoder.joined(encoder.labels, ids, at)]
                backs = [hashlib.sha256(back.encode()).hexdigest() for back in decoded]
                columns = [batch.column("id").slice(start, len(texts)), pa.array(np.diff(at), pa.int64()), pa.array(hashes, pa.string()), pa.array(backs, pa.string())]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns, names = [*columns, pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids)), pa.array(decoded, pa.string())], [*names, "ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                start, held, texts = row + 1, 0, []

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
