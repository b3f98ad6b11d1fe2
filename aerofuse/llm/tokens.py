"""Token ids of many texts, each distinct unit of text encoded once per worker."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A single space or line feed between two other characters always begins a new piece of the byte-level
# pattern: a piece holds a space only in front, and a line feed there is a piece of its own. So a text may
# be cut at these places and the parts encoded alone, whatever stands around them. Arrow cuts texts in which
# no two white-space characters meet; in the others the places are looked for one by one.
_BLANK = "[\\t-\\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"  # \\s of str
_LOOSE = f"^{_BLANK}|{_BLANK}$|{_BLANK}{_BLANK}"
_PLACE = re.compile(r"(?<=\S)([ \n])(?=\S)")
# A unit follows a space, unless it begins with this mark. No unit begins with a tabulator of its own but the
# first of a text, which has the mark before it.
_MARK = "\t"
_FEED = "\n"
_ENDINGS = ".,;:!?"

LEARNT_UNITS = 1 << 14  # encoded at a time
MERGED_UNITS = 64  # longer texts take longer for each unit
MEMO_UNITS = 1_200_000  # distinct units remembered by a worker; the memory is emptied when full


def cuts_at_spaces(path: str) -> bool:
    """Whether this tokenizer file splits byte-level pieces as above, so that texts may be cut at spaces."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    before = spec.get("pre_tokenizer") or {}
    plain = all(
        not (t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"])
             or all(c.isalpha() or c in _ENDINGS for c in t["content"]))
        for t in spec.get("added_tokens", ())
    )
    return (
        before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        and spec.get("normalizer") is None and plain and _merges_text_only(spec["model"])
        and (spec.get("post_processor") or {}).get("type") in (None, "ByteLevel")
    )


def _merges_text_only(model: dict) -> bool:
    """Whether the model merges byte characters, all of which it knows, and never the two that no text has."""
    merges = (m if isinstance(m, str) else " ".join(m) for m in model.get("merges", ()))
    ends = {_BYTE_CHARACTERS[_END_OF_UNIT], _BYTE_CHARACTERS[_END_OF_PIECE]}
    special = ("continuing_subword_prefix", "end_of_word_suffix", "dropout", "ignore_merges")
    return (
        model.get("type") == "BPE" and not any(model.get(x) for x in special) and all(c in model["vocab"] for c in _BYTE_CHARACTERS.values())
        and not any(ends.intersection(m) for m in merges)
    )


BLOCK_BYTES = 1_000_000  # bytes of text whose units are held at a time


class _Units(dict):
    """Number of each unit; one that is asked for first gets the next number and waits to be encoded."""

    def __init__(self) -> None:
        super().__init__({_FEED: 0})
        self.waiting: list = []

    def __missing__(self, unit):
        self.waiting.append(unit)
        number = self[unit] = len(self)
        return number


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it is printable."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


_BYTE_CHARACTERS = _byte_characters()
# Bytes that no UTF-8 text has.
_END_OF_UNIT, _END_OF_PIECE = 0xFE, 0xFF
_SEPARATED = _BYTE_CHARACTERS | {ord("\n"): _BYTE_CHARACTERS[_END_OF_UNIT], ord("\r"): _BYTE_CHARACTERS[_END_OF_PIECE]}


class Encoder:
    """Ids as ``tokenizers`` gives them, without added special tokens; special strings as by its default."""

    def __init__(self, path: str, memo_units: int = MEMO_UNITS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merging = Tokenizer(self.tokenizer.model)  # takes what it gets as one piece
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo_units = memo_units
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.by_unit = cuts_at_spaces(path) and len(feed) == 1
        self.feed = feed[0] if self.by_unit else 0
        self.end_of_unit, self.end_of_piece = (self.tokenizer.token_to_id(_BYTE_CHARACTERS[b]) for b in (_END_OF_UNIT, _END_OF_PIECE))
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self._forget()

    def _forget(self) -> None:
        self.known = _Units()
        self.ids = np.full(1 << 16, self.feed, self.dtype)
        self.used = 1
        self.begins = np.zeros(1 << 14, np.int64)
        self.lengths = np.ones(1 << 14, np.int32)

    def _learn(self) -> None:
        """Encode the waiting units: words and their marks by the model itself, the others through the whole tokenizer."""
        units, self.known.waiting = self.known.waiting, []
        n = len(self.known) - len(units)
        self.begins, self.lengths = _room(self.begins, len(self.known)), _room(self.lengths, len(self.known))
        words, word_at, others, other_at, alone, alone_at = [], [], [], [], [], []
        for k, unit in enumerate(units, n):
            if unit[:1] == _MARK:
                space, unit = "", unit[1:]
            else:
                space = " "
            if unit.isalpha():
                words.append(space + unit)
                word_at.append(k)
            elif unit[:-1].isalpha() and unit[-1] in _ENDINGS:
                words.append(f"{space}{unit[:-1]}\r{unit[-1]}")
                word_at.append(k)
            elif not unit or unit[0].isspace() or unit[-1].isspace() or "\n" in unit:
                alone.append(space + unit)
                alone_at.append(k)
            else:
                others.append(space + unit)
                other_at.append(k)
        # Some at a time, for the memory that the library's results take.
        for k in range(0, len(words), LEARNT_UNITS):
            self._add(word_at[k : k + LEARNT_UNITS], *self._merged(words[k : k + LEARNT_UNITS]))
        for k in range(0, len(others), LEARNT_UNITS):
            # One to a line: the line feed's id, which none of them holds, separates them.
            text = "\n".join(others[k : k + LEARNT_UNITS])
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            ends = np.append(np.flatnonzero(ids == self.feed), len(ids))
            self._add(other_at[k : k + LEARNT_UNITS], ids[ids != self.feed], np.diff(ends, prepend=-1) - 1)
        if alone:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)]
            self._add(alone_at, np.fromiter(chain.from_iterable(found), self.dtype), np.fromiter(map(len, found), np.int64))

    def _merged(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units made of letters, with a carriage return between their pieces. Many are merged in one call:
        no merge holds the bytes that stand for the ends of units and pieces, so none goes across."""
        some = ["\n".join(words[k : k + MERGED_UNITS]) + "\n" for k in range(0, len(words), MERGED_UNITS)]
        some = [text.encode().decode("latin-1").translate(_SEPARATED) for text in some]
        found = self.merging.encode_batch_fast(some, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable([e.ids for e in found]), self.dtype)
        ends = ids == self.end_of_unit
        kept = ~ends & (ids != self.end_of_piece)
        return ids[kept], np.diff(np.cumsum(kept)[ends], prepend=0)

    def _add(self, at: list, ids: np.ndarray, lengths: np.ndarray) -> None:
        assert len(lengths) == len(at) and lengths.sum() == len(ids)
        self.ids = _room(self.ids, self.used + len(ids))
        self.ids[self.used : self.used + len(ids)] = ids
        self.begins[at] = self.used + np.cumsum(lengths) - lengths
        self.lengths[at] = lengths
        self.used += len(ids)

    def _whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), self.dtype, int(counts.sum())), counts

    def encode(self, texts: pa.Array | list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, end to end, and the number of ids of each. None counts as empty."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        texts = pc.fill_null(texts, "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        found, lo = [(np.zeros(0, self.dtype), np.zeros(0, np.int64))], 0
        while lo < len(texts):  # some at a time, for the memory that their units take
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + BLOCK_BYTES, "right")))
            some = texts.slice(lo, hi - lo)
            found.append(self._by_unit(some) if self.by_unit else self._whole(some))
            lo = hi
        ids, counts = (np.concatenate(x) for x in zip(*found, strict=True))
        return ids, counts

    def _by_unit(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists = _units(texts)
        coded = lists.flatten().dictionary_encode()
        if len(self.known) > self.memo_units:
            self._forget()
        units = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # several times faster than to_pylist
        at = np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))
        if self.known.waiting:
            self._learn()
        # The ids of the block's distinct units, then those of all its units in order.
        begin, lengths = self.begins[at], self.lengths[at]
        ends = np.zeros(len(at) + 1, np.int32)
        np.cumsum(lengths, out=ends[1:])
        distinct = self.ids[np.arange(ends[-1]) + np.repeat(begin - ends[:-1], lengths)]
        found = pa.ListArray.from_arrays(pa.array(ends), pa.array(distinct)).take(coded.indices)
        last = np.cumsum(lists.value_lengths().to_numpy(), dtype=np.int64)
        return found.flatten().to_numpy(), np.diff(found.offsets.to_numpy()[last], prepend=0).astype(np.int64)


def _units(texts: pa.Array) -> pa.Array:
    """The units of each text, as a list per text."""
    loose = pc.match_substring_regex(texts, _LOOSE)
    if not pc.any(loose).as_py():
        return _cut(texts)
    tight = pc.invert(loose)
    found = pa.concat_arrays([_cut(texts.filter(tight)), pa.array([_cut_loose(t) for t in texts.filter(loose).to_pylist()], pa.list_(texts.type))])
    # Back into the order of the texts.
    order = np.concatenate([np.flatnonzero(tight.to_numpy(zero_copy_only=False)), np.flatnonzero(loose.to_numpy(zero_copy_only=False))])
    return found.take(pa.array(np.argsort(order)))


def _cut(texts: pa.Array) -> pa.Array:
    marked = pc.binary_join_element_wise(pa.scalar(_MARK, texts.type), texts, pa.scalar("", texts.type))
    return pc.split_pattern(pc.replace_substring(marked, "\n", f" \n {_MARK}"), " ")


def _cut_loose(text: str) -> list[str]:
    parts = _PLACE.split(text)
    units = [_MARK + parts[0]]
    for separator, unit in zip(parts[1::2], parts[2::2], strict=True):
        units += [unit] if separator == " " else [_FEED, _MARK + unit]
    return units


def _room(array: np.ndarray, n: int) -> np.ndarray:
    if n <= len(array):
        return array
    grown = np.zeros(max(n, 2 * len(array)), array.dtype)
    grown[: len(array)] = array
    return grown


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder for this file; it is kept between tasks."""
    return Encoder(path)
