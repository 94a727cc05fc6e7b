"""Ids of public tokenizers for whole texts, with each distinct word encoded once in a task process.

Both tokenizers cut a text where a space or a line end stands between two words, whatever the words are, so a text's
ids are those of its words end to end; so they do before a comma or full stop that ends a word after a letter. Texts where that is not certain (white space of other kinds, control characters
that libraries class differently, spellings of special tokens) are encoded whole, by the same library.

Words are found by a 64-bit hash and then compared byte by byte; a text with a word that another's hash meets is encoded
whole too.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pandas as pd
import pyarrow as pa

from ._base import SPACE, begins_of, bytes_of, words_of

#: Most words that a process remembers; beyond it the memory starts afresh.
MOST_WORDS = 3_000_000
#: New words that are handed to the tokenizer as one text.
JOINED = 500
#: Bytes that begin white space or control characters which libraries class differently, or "<|"; then what makes it sure.
LEADS = np.zeros(256, bool)
LEADS[[0x01, 0x1C, 0x1D, 0x1E, 0x1F, 0x3C, 0xC2, 0xE1, 0xE2, 0xE3]] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
UNSURE = re.compile(rb"[\x01\x1c-\x1f]|<\||\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


def _spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Every place of the stretches that begin at `start`."""
    total = int(length.sum())
    kind = np.int32 if total + int(start.max(initial=0)) < 1 << 31 else np.int64
    return np.arange(total, dtype=kind) + np.repeat((start - np.cumsum(length) + length).astype(kind), length)


class Encoder:
    """`spaces`: white space has ids of its own, and a word after a space other ids than one after a line end."""

    def __init__(self, file: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(file), end_id
        ids = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        self.spaces = ids("a b") != ids("a") + ids("b")
        self.between = "\n" if self.spaces else " \x01 "
        self.mark = np.array(ids(self.between), np.uint32)
        self.line = ids("\n")
        self.tails = np.zeros(256, np.uint32)
        for c in ",.":
            if len(ids(c)) == 1 and ids(f"a{c} a") == ids("a") + ids(c) + ids(" a"):
                self.tails[ord(c)] = ids(c)[0]
        self.forget()

    def forget(self) -> None:
        self.known = self.recent = pd.Index(np.empty(0, np.uint64))
        self.flat, self.at, self.len = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)
        self.bytes, self.byte_at, self.byte_len = np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)

    def _ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids end to end and how many each word has."""
        groups = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        ids, length = [], []
        for group, got in zip(groups, self.tokenizer.encode_batch_fast([self.between.join(g) for g in groups], add_special_tokens=False), strict=True):
            own = np.array(got.ids, np.uint32)
            marks = np.flatnonzero(own == self.mark[0])
            if len(self.mark) == 1 and len(marks) == len(group) - 1:
                ids.append(np.delete(own, marks))
                length.append(np.diff(np.concatenate([[-1], marks, [len(own)]])) - 1)
            else:
                each = [x.ids for x in self.tokenizer.encode_batch(group, add_special_tokens=False)]
                ids.append(np.array([i for x in each for i in x], np.uint32))
                length.append(np.array([len(x) for x in each], np.int64))
        return np.concatenate(ids), np.concatenate(length)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        found = self.known.get_indexer(keys)
        missing = np.flatnonzero(found < 0)
        if len(missing) and len(self.recent):
            late = self.recent.get_indexer(keys[missing])
            found[missing] = np.where(late < 0, -1, late + len(self.known))
        return found

    def _places(self, raw: np.ndarray, keys: np.ndarray, start: np.ndarray, length: np.ndarray, spaced: np.ndarray) -> np.ndarray:
        """Where each word stands in the memory, after learning those that are new."""
        codes, distinct = pd.factorize(keys)
        found = self._find(distinct)
        if (new := np.flatnonzero(found < 0)).size:
            if len(self.known) + len(self.recent) + len(new) > MOST_WORDS:
                self.forget()
                new = np.arange(len(distinct))
            example = np.empty(len(distinct), np.int64)
            example[codes] = np.arange(len(codes))
            own = example[new]
            self.byte_at = np.concatenate([self.byte_at, len(self.bytes) + np.cumsum(length[own]) - length[own]])
            self.byte_len = np.concatenate([self.byte_len, length[own]])
            self.bytes = np.concatenate([self.bytes, raw[_spread(start[own], length[own])]])
            data = raw.tobytes()
            words = [(" " if s else "") + data[a : a + n].decode() for a, n, s in zip(*(x[own].tolist() for x in (start, length, spaced)), strict=True)]
            ids, size = self._ids_of(words)
            self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(size) - size])
            self.len, self.flat = np.concatenate([self.len, size]), np.concatenate([self.flat, ids])
            self.recent = self.recent.append(pd.Index(distinct[new]))
            if len(self.recent) > len(self.known) // 4:  # a large index is built anew only when it has grown by a quarter
                self.known, self.recent = self.known.append(self.recent), self.recent[:0]
            found = self._find(distinct)
        return found[codes]

    def _same(self, raw: np.ndarray, start: np.ndarray, length: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Which words have the bytes of the remembered word at their place."""
        same = self.byte_len[place] == length
        some = np.flatnonzero(same & (length > 0))
        if len(some):
            n = length[some]
            equal = raw[_spread(start[some], n)] == self.bytes[_spread(self.byte_at[place[some]], n)]
            same[some] = np.logical_and.reduceat(equal, np.cumsum(n) - n)
        return same

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, the end id after each, and where each text's ids begin. Null counts as empty."""
        raw, off = bytes_of(texts)
        inner = ~SPACE[raw]
        edge, tail = np.zeros(len(raw) + 1, bool), np.zeros(len(raw) + 1, bool)
        edge[off] = True
        mark = np.flatnonzero((self.tails > 0)[raw])
        mark = mark[~edge[mark]]
        mark = mark[LETTER[raw[mark - 1]]]
        mark = mark[edge[mark + 1] | SPACE[raw[np.minimum(mark + 1, len(raw) - 1)]]] if len(mark) else mark
        tail[mark] = True
        inner[mark] = False
        hashes, length, counts = words_of(raw, off, inner)
        per, doc = np.diff(counts), np.repeat(np.arange(len(off) - 1), np.diff(counts))
        start = begins_of(inner, off) if len(raw) else np.empty(0, np.int64)
        stop = start + length
        ended = np.zeros(len(start), np.uint32)
        has = stop < len(raw)
        ended[has] = np.where(tail[stop[has]], self.tails[raw[stop[has]]], 0)
        stop = stop + (ended > 0)
        whole = np.zeros(len(off) - 1, bool)
        if (lead := np.flatnonzero(LEADS[raw])).size:
            data = raw.tobytes()
            found = [i for i in lead.tolist() if UNSURE.match(data, i)]
            whole[np.searchsorted(off, found, "right") - 1] = True
        if self.spaces:
            before = np.where(np.arange(len(doc)) == counts[doc] if len(doc) else False, off[doc], np.append(0, stop)[: len(doc)])
            gap = start - before
            single = np.where(start > 0, raw[np.maximum(start, 1) - 1], 0) if len(raw) else np.empty(0, np.uint8)
            first = np.arange(len(doc)) == counts[doc]
            odd = np.where(first, gap != 0, (gap != 1) | ((single != 32) & (single != 10)))
            np.logical_or.at(whole, doc[odd], True)
            ends = np.where(per > 0, stop[np.maximum(counts[1:] - 1, 0)] if len(start) else 0, off[:-1])
            whole |= ends != off[1:]
            spaced, line = ~first & (single == 32), ~first & (single == 10)
        else:
            spaced = line = np.zeros(len(doc), bool)
        used = ~whole[doc]
        place = self._places(raw, (hashes ^ spaced.astype(np.uint64))[used], start[used], length[used], spaced[used])
        if not (same := self._same(raw, start[used], length[used], place)).all():
            whole[doc[used][~same]] = True
            place, used = place[~whole[doc[used]]], ~whole[doc]
        size, lines, of, ended = self.len[place], line[used].astype(np.int64), doc[used], ended[used]
        own = {int(i): np.array(self.tokenizer.encode(texts[int(i)].as_py(), add_special_tokens=False).ids, np.uint32) for i in np.flatnonzero(whole)}
        step = size + lines + (ended > 0)
        total = np.bincount(of, step, len(off) - 1).astype(np.int64)
        for i, ids in own.items():
            total[i] = len(ids)
        at = np.concatenate([[0], np.cumsum(total + 1)])
        out = np.empty(at[-1], np.uint32)
        out[at[1:] - 1] = self.end
        rank = np.cumsum(step) - step
        base = np.cumsum(np.bincount(of, step, len(off) - 1)).astype(np.int64)
        base = np.concatenate([[0], base[:-1]])
        to = at[of] + rank - base[of]
        if lines.any():
            out[to[lines > 0]] = self.line[0]
        to = to + lines
        out[(to + size)[ended > 0]] = ended[ended > 0]
        out[_spread(to, size)] = self.flat[_spread(self.at[place], size)]
        for i, ids in own.items():
            out[at[i] : at[i] + len(ids)] = ids
        return out, at


_made: dict[tuple[str, int], Encoder] = {}


def encoder(file: str, end_id: int) -> Encoder:
    """One for each file and task process."""
    if (file, end_id) not in _made:
        _made[file, end_id] = Encoder(file, end_id)
    return _made[file, end_id]
