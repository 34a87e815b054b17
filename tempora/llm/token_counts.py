"""Operator 12: exact token counts of every prefix by dynamic programming over byte-pair tokens.

The tokens of a byte-pair encoding have two properties.  A list of tokens is
the encoding of its bytes when every two neighbours are the encoding of
theirs; and the encoding of a prefix, without its last token, is the
encoding of a shorter prefix.  So the last token of each prefix is the one
token that ends there and fits behind the last token of the prefix before
it, and the count is that prefix's count plus one (``Prefixes.pretoken``).

Between pretokens nothing merges, and a pretoken never reaches from a
non-space into a space.  A text is therefore cut in units, a run of white
space with the run of other characters behind it, whose counts add up.
Equal units have equal steps and are worked out once per task.

``prefix_counts`` stores for each document the step of the count at each
character: ``steps`` has one signed byte per character, and steps that do
not fit are listed in ``wide``.  Counts can fall: the step at a character
that joins two tokens is negative.  ``answer`` reads the store: the count of
any prefix, and the longest prefix within a budget, without encoding again.

Defined results: null text is empty, 0 tokens; special tokens in a text
count as the library counts them, one each, and a prefix that ends inside
one is ordinary text; very long texts are stored whole; rows with a null or
repeated id are counted one by one; other columns are ignored.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

# units and pretokens that a task remembers, and the longest worth it
UNITS, UNIT_CHARS = 350_000, 64
# fixed values: the pretoken pattern of this family of encodings, and Unicode's white space
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
WHITE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WIDE = -128


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable ones themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _packed(count: list[int]) -> bytes:
    steps = [y - x for x, y in zip(count, count[1:])]
    if min(steps) <= _WIDE or max(steps) > 127:
        raise OverflowError
    return bytes([x & 255 for x in steps])


class Prefixes(dict):
    """Steps of the token count by unit; a missing unit is worked out.  Made once per task from the tokenizer file."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or spec.get("normalizer") or model.get("ignore_merges") or \
                split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            raise ValueError(f"{path} is no plain byte-level BPE")
        letters = _byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        self.rank: dict[tuple[bytes, bytes], int] = {}
        for i, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank[raw(a), raw(b)] = i
        # what a token is merged from, and when
        self.made = {a + b: (i, a, b) for (a, b), i in sorted(self.rank.items(), key=lambda x: -x[1])}
        # tokens by their bytes read backwards, as nested dicts; 256 marks the end of a token
        self.back: dict = {}
        for token in {bytes([b]) for b in range(256)} | {a + b for a, b in self.rank}:
            at = self.back
            for byte in reversed(token):
                at = at.setdefault(byte, {})
            at[256] = token
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self.known: dict[str, bytes] = {}
        # the last token of byte prefixes
        self.states: dict[bytes, bytes] = {}
        self.special = [t["content"] for t in spec.get("added_tokens", ())]
        if any(a != b and a in b for a in self.special for b in self.special) or \
                any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", ())):
            raise ValueError("special tokens inside one another, or that strip or need borders, are not supported")
        self.at_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.pretokens = regex.compile(PRETOKEN)
        self.units = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
        self.blank = re.compile(f"[{WHITE}]*")

    def _fit(self, a: bytes, b: bytes) -> bool:
        """Whether the encoding of ``a + b`` is these two tokens: no merge across the border comes first.

        The merges of both are undone from the last one on.  While a piece x ends at the border and y begins
        there, they merge if their rank is below that of the merge that takes x away to the left, and not above
        that of the merge that takes y away to the right (of equal ranks the left one comes first).
        """
        known = self.fits.get((a, b))
        if known is not None:
            return known
        rank, made, never = self.rank, self.made, len(self.rank)
        x, y, x_goes, y_goes, known = a, b, never, never, True
        while True:
            r = rank.get((x, y), never)
            if r < x_goes and r <= y_goes and r < never:
                known = False
                break
            rx, ry = made.get(x, (-1,))[0], made.get(y, (-1,))[0]
            if rx > ry:
                x_goes, x = rx, made[x][2]
            elif ry >= 0:
                y_goes, y = ry, made[y][1]
            else:
                break
        if len(self.fits) > UNITS:
            self.fits.clear()
        self.fits[a, b] = known
        return known

    def pretoken(self, raw: bytes) -> list[int]:
        """Token count of every byte prefix of one pretoken, the empty one first."""
        size, states = len(raw), self.states
        short = size <= UNIT_CHARS
        last: list[bytes | None] = [None]
        count = [0]
        begun = 1
        while short and begun <= size:
            # words that begin alike share the states of their common prefixes
            token = states.get(raw[:begun])
            if token is None:
                break
            last.append(token)
            count.append(count[begun - len(token)] + 1)
            begun += 1
        if short and len(states) > 2 * UNITS:
            states.clear()
        fits, fit, back = self.fits, self._fit, self.back
        for end in range(begun, size + 1):
            at, begin = back, end
            while begin:
                begin -= 1
                at = at.get(raw[begin])
                if at is None:
                    break
                token = at.get(256)
                if token is not None:
                    before = last[begin]
                    # a prefix has one last token: the one that fits
                    if before is None or fits.get((before, token)) or fit(before, token):
                        last.append(token)
                        count.append(count[begin] + 1)
                        if short:
                            states[raw[:end]] = token
                        break
        return count

    def chars(self, text: str) -> list[int]:
        """Token count of every character prefix of one pretoken, the empty one first."""
        raw = text.encode()
        count = self.pretoken(raw)
        if len(raw) != len(text):
            ends = np.cumsum([0] + [len(c.encode()) for c in text])
            count = [count[e] for e in ends]
        if text in CONTRACTIONS and len(text) == 3:
            # a prefix that ends before the last letter is an apostrophe and a letter
            count[2] = 2
        return count

    def own(self, part: str) -> bytes:
        """Packed steps of one pretoken."""
        known = self.known.get(part)
        if known is None:
            known = _packed(self.chars(part))
            if len(part) <= UNIT_CHARS:
                if len(self.known) >= UNITS:
                    self.known.clear()
                self.known[part] = known
        return known

    def unit(self, text: str) -> list[int]:
        """Token count of every prefix of a unit: white space, then other characters."""
        total, base = [0], 0
        for part in self.pretokens.findall(text):
            count = self.chars(part)
            total += [base + c for c in count[1:]]
            base += count[-1]
        blank = self.blank.match(text).end()
        # a prefix that ends in the white space has it as one pretoken
        total[1:blank + 1] = self.chars(text[:blank])[1:]
        return total

    def __missing__(self, unit: str) -> bytes:
        if self.blank.match(unit).end() > 1:
            found = _packed(self.unit(unit))
        else:
            found = b"".join(map(self.own, self.pretokens.findall(unit)))
        if len(unit) <= UNIT_CHARS:
            if len(self) >= UNITS:
                self.clear()
            self[unit] = found
        return found

    def plain(self, text: str) -> np.ndarray | bytes:
        """Steps of a text without special tokens: packed, or as numbers where one does not fit a byte."""
        units = self.units.findall(text)
        try:
            return b"".join(map(self.__getitem__, units))
        except OverflowError:
            return np.concatenate([np.diff(np.array(self.unit(u), np.int64)) for u in units])

    def steps(self, text: str) -> np.ndarray | bytes:
        """Steps of the count at each character of a whole text."""
        if self.at_special is None or not self.at_special.search(text):
            return self.plain(text)
        out, begin = [], 0
        for m in self.at_special.finditer(text):
            # up to the last character of the special token all is ordinary; there it becomes one token
            head = self.plain(text[begin:m.end() - 1])
            head = np.frombuffer(head, np.int8).astype(np.int64) if isinstance(head, bytes) else head
            before = self.plain(text[begin:m.start()])
            before = int(np.frombuffer(before, np.int8).sum(dtype=np.int64) if isinstance(before, bytes)
                         else before.sum())
            out += [head, [before + 1 - int(head.sum())]]
            begin = m.end()
        rest = self.plain(text[begin:])
        out.append(np.frombuffer(rest, np.int8).astype(np.int64) if isinstance(rest, bytes) else rest)
        return np.concatenate(out).astype(np.int64)


_made: dict[str, Prefixes] = {}


def _prefixes(path: str) -> Prefixes:
    if path not in _made:
        _made[path] = Prefixes(path)
    return _made[path]


WIDE_TYPE = pa.list_(pa.struct([("at", pa.int64()), ("step", pa.int64())]))
STORE_SCHEMA = ("doc_id long, n_bytes long, n_chars long, n_tokens long, steps binary, "
                "wide array<struct<at:long,step:long>>")


def prefix_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The store, one row per input row (STORE_SCHEMA); ``tokenizer`` is a file that every executor can read."""
    def count(batches):
        prefixes = _prefixes(tokenizer)
        for b in (x.slice(i, 512) for x in batches for i in range(0, x.num_rows, 512)):
            out = {c: [] for c in ("n_bytes", "n_chars", "n_tokens", "steps", "wide")}
            for text in b.column(1).to_pylist():
                text = text or ""
                steps, wide = prefixes.steps(text), []
                if isinstance(steps, np.ndarray):
                    total = int(steps.sum())
                    far = np.flatnonzero((steps <= _WIDE) | (steps > 127))
                    wide = [{"at": int(x), "step": int(steps[x])} for x in far]
                    steps[far] = _WIDE
                    steps = steps.astype(np.int8).tobytes()
                else:
                    total = int(np.frombuffer(steps, np.int8).sum(dtype=np.int64))
                for c, v in zip(out, (len(text.encode()), len(text), total, steps, wide)):
                    out[c].append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_chars", "n_tokens")),
                 pa.array(out["steps"], pa.binary()), pa.array(out["wide"], WIDE_TYPE)],
                ["doc_id", *out])
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(count, STORE_SCHEMA)


def counts(steps: bytes, wide) -> np.ndarray:
    """Token count of every character prefix of a stored text, the empty one first."""
    step = np.frombuffer(steps, np.int8).astype(np.int64)
    for w in wide or ():
        step[w["at"]] = w["step"]
    return np.concatenate([[0], np.cumsum(step)])


def answer(store: DataFrame, places: list[int] | tuple = (), budgets: list[int] | tuple = ()) -> DataFrame:
    """doc_id with ``tokens_at`` and ``fits``, both from the store alone.

    ``tokens_at`` has the tokens of the first ``places[i]`` characters (of all, where the text is shorter).
    ``fits`` has the most characters, from the start, that encode to ``budgets[i]`` tokens or fewer.
    """
    places, budgets = list(places), list(budgets)

    def read(batches):
        for b in batches:
            at, fits = [], []
            for steps, wide in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                total = counts(steps, wide)
                at.append([int(total[min(max(p, 0), len(total) - 1)]) for p in places])
                fits.append([int(np.flatnonzero(total <= max(x, 0))[-1]) for x in budgets])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(at, pa.list_(pa.int64())), pa.array(fits, pa.list_(pa.int64()))],
                ["doc_id", "tokens_at", "fits"])
    return store.select("doc_id", "steps", "wide") \
        .mapInArrow(read, "doc_id long, tokens_at array<long>, fits array<long>")
