"""BPE encoding and decoding by a tokenization automaton (operator 5).

The merges of a tokenizer file are compiled, one merge gadget after the other,
into a deterministic automaton whose arcs carry tokens and which accepts just
the token sequences that BPE yields. Its states are classes of tokens: after a
token, the state says which arcs are gone. The gadget for merge (u, v) -> w

* gives u a state of its own if it shares one (a copy that remembers its parent
  and how many merges the parent had seen),
* takes the arc v away from that state, and
* adds an arc w, which leads where v leads, wherever u could be followed
  (where u is v, w leads to where u led before, and may not follow u).

So every token has one target state, and an arc's presence depends only on the
merges recorded in the state's chain of copies. When all gadgets are made, the
automaton is written out as a table, a row of bits for each state and a bit for
each token; the arcs that a merge took from a state are runs of tokens if tokens
are numbered along the tree of their left parts. Encoding walks a character trie
of arc labels and looks arcs up in the table. Each prefix has at most one valid
tokenization, so a position that failed is never tried again and a word takes time
in proportion to its length. Decoding emits the labels of the ids' arcs.

Which characters are letters, numbers and white space is asked of the tokenizers
library once for each process, as its Unicode version is not Python's; texts with
characters that Python does not know are normalised by it, too.

Defined cases: a null or empty text has no tokens; strings of special tokens in
a text become those tokens; of special tokens that start at one place the longest
is taken; a long text is encoded whole; repeated rows are encoded once each; an
empty table gives an empty result; further columns are ignored, whatever their
names.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from .common import CACHES, slices

#: Words kept in a worker's cache before the older half goes.
CACHE_WORDS = 200_000
RESULT_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
ENCODED_SCHEMA = "doc_id long, ids array<int>, decoded string"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable Latin-1, else the next one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols = {b: chr(b) for b in shown}
    for b in range(256):
        symbols.setdefault(b, chr(0x100 + len(symbols) - len(shown)))
    return [symbols[b] for b in range(256)]


class TokenAutomaton:
    """Tokens, the state each one leads to, the arcs taken from the states, and the trie of arc labels."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], word_end: str):
        self.end = "\ue000"  # stands for the word-end suffix; byte symbols lie below U+0200
        inner = lambda t: t[: -len(word_end)] + self.end if word_end and t.endswith(word_end) and len(t) > len(word_end) else t
        self.labels = {i: t for t, i in vocabulary.items()}
        ids = {inner(t): i for t, i in vocabulary.items()}
        self.never = len(merges) + 1
        self.left: dict[int, int] = {}  # token -> left part of its merge
        self.right: dict[int, int] = {}  # token -> right part of its merge
        self.made: dict[int, int] = {}  # token -> number of its merge; characters have none
        self.taken: dict[int, dict[int, int]] = {}  # token -> arcs its own gadgets took from its state, with the merge
        self.state: dict[int, int] = {}  # token -> number of its target state
        self.sharing: dict[int, int] = {0: len(ids)}
        self.dead: set[int] = set()  # tokens whose merge never finds its pair
        self.edges: dict[int, list[tuple[int, int]]] = {}
        self.chains: dict[int, list[tuple[int, int]]] = {}
        for number, (u, v) in enumerate(merges, 1):
            self._gadget(number, ids[inner(u)], ids[inner(v)], ids[inner(u) + inner(v)])
        self._write_out(list(ids.values()))
        self.longest = max(map(len, ids))
        self.trie: dict = {}  # character -> node; under None, the token whose label ends here, its length and its place in the table
        for label, token in ids.items():
            if token in self.dead:
                continue
            node = self.trie
            for c in label:
                node = node.setdefault(c, {})
            node[None] = (token, len(label), self.place[token])

    def _gadget(self, number: int, u: int, v: int, w: int) -> None:
        if u in self.dead or v in self.dead or not self._has_arc(u, v):
            if w not in self.made:
                self.dead.add(w)
            return
        if w not in self.made:
            self.dead.discard(w)
            self.edges.pop(w, None)
            self.chains.pop(w, None)
            self.left[w], self.right[w], self.made[w] = u, v, number
            self.state[w] = target = self.state.get(v, 0)  # where v leads before this merge takes anything
            self.sharing[target] += 1
        state = self.state.get(u, 0)
        if state == 0 or self.sharing[state] > 1:
            self.sharing[state] -= 1
            self.state[u] = state = len(self.sharing)
            self.sharing[state] = 1
        own = self.taken.setdefault(u, {})
        own.setdefault(v, number)
        if u == v:
            own.setdefault(w, number)

    def _edge(self, token: int, part: dict[int, int]) -> list[tuple[int, int]]:
        """The token, its left (right) part, that part's and so on, each with the number of the merge that used it."""
        found, used = [], self.never
        while True:
            found.append((token, used))
            if token not in part:
                return found
            used, token = self.made[token], part[token]

    def _has_arc(self, last: int, token: int) -> bool:
        """Whether the state that ``last`` leads to has an arc for the token.

        A state has what its copies' parents had lost when it was copied, so
        the merges to look at are those along the right edge of ``last``; an
        arc went if a part on its left edge went before the next part was made.
        """
        edge = self.edges.get(token)
        if edge is None:
            edge = self.edges[token] = self._edge(token, self.left)
        chain = self.chains.get(last)
        if chain is None:
            chain = self.chains[last] = self._edge(last, self.right)
        for part_of_last, seen in chain:
            taken = self.taken.get(part_of_last)
            if taken is not None:
                for part, used in edge:
                    at = taken.get(part)
                    if at is not None and at < seen and at < used:
                        return False
        return True

    def _write_out(self, tokens: list[int]) -> None:
        """The transition table: for each state a row of bits, one for each token in the order of ``place``."""
        children: dict[int, list[int]] = {}
        for token, part in self.left.items():  # in the order they were made
            children.setdefault(part, []).append(token)
        self.place: dict[int, int] = {}
        after: dict[int, int] = {}  # token -> end of the run of tokens that start with it
        todo = [t for t in reversed(tokens) if t not in self.left]
        while todo:
            token = todo.pop()
            if token < 0:
                after[~token] = len(self.place)
                continue
            self.place[token] = len(self.place)
            todo.append(~token)
            todo += reversed(children.get(token, []))
        lost: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}  # token -> merges, begins and ends of the runs they took
        for token, arcs in self.taken.items():
            runs = []
            for arc, number in arcs.items():
                made_later = children.get(arc, [])[bisect_right(children.get(arc, []), number, key=self.made.__getitem__) :]
                runs.append((number, self.place[arc], self.place[arc] + 1))
                runs.append((number, self.place[made_later[0]] if made_later else after[arc], after[arc]))
            lost[token] = tuple(np.array(sorted(runs)).T)
        self.rows: list[bytes] = [b""] * len(self.sharing)
        for token in tokens:
            state = self.state.get(token, 0)
            if self.rows[state] or token in self.dead:
                continue
            change = np.zeros(len(self.place) + 1, np.int32)
            for part, seen in self._edge(token, self.right):
                if part in lost:
                    numbers, begins, ends = lost[part]
                    n = np.searchsorted(numbers, seen)
                    np.add.at(change, begins[:n], 1)
                    np.subtract.at(change, ends[:n], 1)
            self.rows[state] = np.packbits(np.cumsum(change[:-1]) == 0, bitorder="little").tobytes()

    def follows(self, last: int, token: int) -> bool:
        """Whether the table has an arc for the token from the state that ``last`` leads to."""
        place = self.place[token]
        return bool(self.rows[self.state.get(last, 0)][place >> 3] >> (place & 7) & 1)

    def _arcs(self, text: str, at: int) -> list[tuple[int, int, int]]:
        """Tokens whose label starts at this place, their lengths and places in the table; shortest first."""
        found, node = [], self.trie
        for c in text[at : at + self.longest]:
            node = node.get(c)
            if node is None:
                break
            if None in node:
                found.append(node[None])
        return found

    def word(self, symbols: str) -> list[int]:
        """Tokens of one pre-split word, given as byte symbols: the automaton's one accepting path."""
        text = symbols + self.end
        size, rows, state = len(text), self.rows, self.state
        path: list[int] = []
        trail: list[tuple[int, list[tuple[int, int, int]]]] = []
        failed: set[int] = set()
        at, choices = 0, self._arcs(text, 0)
        while True:
            row = rows[state.get(path[-1], 0)] if path else None
            while choices:
                token, length, place = choices.pop()
                end = at + length
                if end not in failed and (row is None or row[place >> 3] >> (place & 7) & 1):
                    break
            else:
                if not path:
                    raise ValueError("no path: the vocabulary lacks a byte symbol")
                failed.add(at)
                path.pop()
                at, choices = trail.pop()
                continue
            path.append(token)
            if end == size:
                return path
            trail.append((at, choices))
            at, choices = end, self._arcs(text, end)


#: Code points in use: planes 0 to 3 without the surrogates, and plane 14. The rest is private or unassigned.
_POINTS = [*range(0xD800), *range(0xE000, 0x40000), *range(0xE0000, 0xE1000)]


def _class(points: Iterable[int]) -> str:
    """Ranges of a character class."""
    ranges: list[list[int]] = []
    for c in points:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in ranges)


def _matched(pattern: str) -> list[int]:
    """The characters that a pattern of the tokenizers library matches."""
    split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
    return [_POINTS[k] for _, (lo, hi) in split.pre_tokenize_str("".join(map(chr, _POINTS))) for k in range(lo, hi)]


def _split_pattern(split: str, classes: list[list[int]], below: int) -> re.Pattern:
    spaces, letters, numbers = (_class(c for c in points if c < below) for points in classes)
    return re.compile(split.replace("[^\\s\\p{L}\\p{N}]", f"[^{spaces}{letters}{numbers}]").replace("[\\p{L}]", f"[{letters}]").replace("[\\p{N}]", f"[{numbers}]"))


def _unknown() -> re.Pattern:
    """A character that Python's tables do not know, or order otherwise among combining marks than the library does."""
    marks = [chr(c) for c in _POINTS if unicodedata.combining(chr(c))]
    near = [chr(c) for c in (0x0301, 0x0323, 0x0315, 0x0327, 0x093C, 0x05B0)]  # marks of several combining classes
    probes = [pair for m in marks for n in near for pair in ("a" + m + n, "a" + n + m)]
    theirs = normalizers.NFC().normalize_str("|".join(probes)).split("|")
    other = {ord(probe[k]) for probe, found in zip(probes, theirs) if unicodedata.normalize("NFC", probe) != found for k in (1, 2) if probe[k] not in near}
    unassigned = [c for c in _POINTS if unicodedata.category(chr(c)) == "Cn"]
    return re.compile("[" + _class(sorted({*unassigned, *other})) + "]")


class WordBpe:
    """Encoder and decoder for a tokenizer file of the word-end kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = TokenAutomaton(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        classes = [_matched(x) for x in ("\\s+", "\\p{L}+", "\\p{N}+")]
        self.split, self.latin_split, self.unknown = _split_pattern(split, classes, 0x110000), _split_pattern(split, classes, 0x100), _unknown()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.labels = self.automaton.labels | {i: t for t, i in self.special.items()}
        self.symbols = byte_symbols()
        self.young: dict[str, tuple[list[int], str]] = {}
        self.old: dict[str, tuple[list[int], str]] = {}

    def _new(self, word: str) -> tuple[list[int], str]:
        found = self.old.get(word)
        if found is None:
            symbols = "".join([self.symbols[b] for b in word.encode("utf-8", "surrogatepass")])
            ids = self.automaton.word(symbols)
            found = ids, " ".join(map(str, ids))
        if len(self.young) >= CACHE_WORDS // 2:
            self.old, self.young = self.young, {}
        if len(word) <= 64:
            self.young[word] = found
        return found

    def words(self, text: str) -> list[str]:
        """Normalise and pre-split; what the pattern does not match is dropped."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            if self.unknown.search(text):
                text = normalizers.Lowercase().normalize_str(normalizers.NFC().normalize_str(text))
            else:
                text = unicodedata.normalize("NFC", text)
                # the library lower-cases character by character
                text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
            return self.split.findall(text)
        return self.latin_split.findall(text.lower())

    def encode(self, text: str | None) -> tuple[list[int], str]:
        """The ids, and the same in decimal joined by blanks."""
        if not text:
            return [], ""
        parts = self.special_split.split(text) if any(map(text.__contains__, self.special)) else [text]
        ids, decimal = [], []
        for part in parts:
            if part in self.special:
                ids.append(self.special[part])
                decimal.append(str(self.special[part]))
                continue
            for word in self.words(part):
                # the generation may turn over inside _new, so look it up each time
                i, d = self.young.get(word) or self._new(word)
                ids += i
                decimal.append(d)
        return ids, " ".join(decimal)

    def batches(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Small batches of a task, after which the worker forgets the words but keeps the tables."""
        yield from slices(batches, keep=_loaded)
        self.young, self.old = {}, {}

    def decode(self, ids: list[int]) -> str:
        """Labels of the arcs, joined by blanks as a tokenizer file without a decoder asks; unknown ids give nothing."""
        try:
            return " ".join(map(self.labels.__getitem__, ids))
        except KeyError:
            return " ".join(self.labels[i] for i in ids if i in self.labels)


_loaded: dict[str, WordBpe] = {}
CACHES.append(_loaded)  # tasks of other operators drop the tokenizer


def tokenizer(path: str) -> WordBpe:
    """The compiled tokenizer, once for each worker process."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def _picked(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """Token count and digests of ids and decoded text; narrow, no shuffle. ``path`` must exist on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, sha = tokenizer(path), hashlib.sha256
        for batch in bpe.batches(batches):
            counts, ids, decoded = [], [], []
            for text in batch.column(1):
                found, decimal = bpe.encode(text.as_py())
                counts.append(len(found))
                ids.append(sha(decimal.encode()).hexdigest())
                decoded.append(sha(bpe.decode(found).encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _picked(docs).mapInArrow(run, RESULT_SCHEMA)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """The ids of each document, and the text that decoding them gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in bpe.batches(batches):
            ids, decoded = [], []
            for text in batch.column(1):
                ids.append(bpe.encode(text.as_py())[0])
                decoded.append(bpe.decode(ids[-1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    return _picked(docs).mapInArrow(run, ENCODED_SCHEMA)
