"""Documents packed into sequences of a fixed number of tokens.

The documents of one task form a stream of tokens. Cuts between sequences are
chosen by dynamic programming over the places where a cut may lie: document
ends (free), sentence ends (a small penalty) and, inside very long sentences,
every few dozen tokens (a larger one). With T the tokens before a place,

    cost[j] = penalty[j] + size - T[j] + min(cost[i] + T[i])   over T[j] - T[i] <= size,

and a monotone queue holds the candidates of the minimum, so that the work is
linear in the number of places. Order is kept: every document lies in adjacent
pieces. The last sequence of a task is cut into powers of two, which need no
padding, where that costs less than filling it up.

Tokenizing dominates. Texts are split where a single space precedes a word,
which is always a border between the tokenizer's own units, and each distinct
part is encoded once per task. Texts with other runs of blanks are encoded whole.
Parts that are new are split into the tokenizer's units (a word, a number, a run
of signs or of blanks), and of these, each distinct one is encoded by the
tokenizer's model; parts with rare characters, or where an apostrophe may open
a unit, go through the whole tokenizer.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from bisect import bisect_left
from collections import deque
from collections.abc import Callable, Iterator
from functools import cache
from itertools import repeat
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from retalake.llm.common import BLANKS, giving_back

if TYPE_CHECKING:
    from tokenizers import Tokenizer

SIZE = 2048
END = 1
#: Tokens of padding that a cut is worth: at a sentence end, and elsewhere.
SENTENCE_CUT = 4
OTHER_CUT = 12
#: Longest stretch without a place to cut.
STRETCH = 64
#: Tokens that are cut into sequences at a time, and bytes of text that are encoded at a time.
SEGMENT = 200_000
CHARS = 500_000
#: Blocks of so much text whose parts are looked up at a time.
LOOKED_UP = 4
#: Texts that the tokenizer gets at a time; its own records of a text are far larger than the ids.
AT_A_TIME = 16
#: Distinct parts whose ids a task remembers; only speed depends on it.
CACHE = 150_000
#: First characters of parts that are no words after a space: none, or a blank of any kind.
NO_WORD = pa.array(["", *(c for c in map(chr, range(0x3001)) if c.isspace())], pa.large_string())
#: Byte that no UTF-8 has, as the vocabulary writes it.
BORDER = "\xff"
#: Letters that may be a unit together with an apostrophe before them.
CONTRACTED = np.frombuffer(b"stmdrvl", np.uint8).astype(np.uint32)


#: Kinds of characters, as the tokenizer's own units tell them apart.
SPACE, BLANK, LETTER, NUMBER, OTHER, STRANGE = range(6)


@cache
def kinds() -> np.ndarray:
    """Kind of each code point up to the last of the table, which stands for all beyond it as well.

    Strange are characters whose category versions of Unicode do not agree on, and rare blanks.
    """
    table = np.full(1 << 16, STRANGE, np.uint8)
    old = unicodedata.ucd_3_2_0
    for i in range(len(table) - 1):
        c = chr(i)
        if c in BLANKS:
            table[i] = SPACE if c == " " else BLANK
        elif not c.isspace():
            now, then = unicodedata.category(c)[0], old.category(c)[0]
            if now == then and old.category(c) not in ("Cn", "Cs"):
                table[i] = {"L": LETTER, "N": NUMBER}.get(now, OTHER)
    return table


@cache
def byte_characters() -> np.ndarray:
    """The character that a byte-level vocabulary writes for each byte: itself if it is visible, else one from 256 on."""
    own = [33 <= b <= 126 or 161 <= b <= 172 or b >= 174 for b in range(256)]
    others = iter(range(256, 512))
    return np.array([b if own[b] else next(others) for b in range(256)], np.uint32)


def gathered(ids: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The stretches of ``ids`` one after the other."""
    before = np.cumsum(counts) - counts
    return ids[np.repeat(starts - before, counts) + np.arange(counts.sum())]


class Encoder:
    """Ids of texts under a byte-level BPE of the ``tokenizers`` library."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is the only one it may use
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.widths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.ends = np.zeros(len(self.widths), bool)
        for token, i in vocabulary.items():  # a character of a byte-level token stands for a byte; C-dot is a line feed
            self.widths[i] = len(token)
            self.ends[i] = token[-1] in ".!?Ċ"
        self.reset()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # The same model takes units that are cut already and written in the vocabulary's characters, many in one text.
        # Between them stands a byte that no UTF-8 has, so that no merge reaches across. A tokenizer with other units
        # than ``kinds`` tells apart, or whose merges know that byte, gets all parts as they are.
        model, cutter = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.border = vocabulary.get(BORDER, -1)
        by_units = (
            self.tokenizer.normalizer is None
            and isinstance(cutter, pre_tokenizers.ByteLevel)
            and cutter.use_regex
            and not cutter.add_prefix_space
            and isinstance(model, models.BPE)
            and not (model.dropout or model.unk_token or model.ignore_merges or model.byte_fallback)
            and not (model.continuing_subword_prefix or model.end_of_word_suffix)
            and [t for t in vocabulary if BORDER in t] == [BORDER]
        )
        self.kinds = kinds() if by_units else np.full(1, STRANGE, np.uint8)
        self.unit_tokenizer = Tokenizer(model)

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.empty(0, np.uint32)
        self.starts = np.empty(0, np.int64)
        self.counts = np.empty(0, np.int64)
        self.again = np.empty(0, bool)

    def _forget(self) -> None:
        """Keep the parts that were met again after they were learned; all go where that would free less than half."""
        kept = np.flatnonzero(self.again)
        if len(kept) > CACHE // 2:
            return self.reset()
        parts = list(self.known)
        counts = self.counts[kept]
        self.ids = gathered(self.ids, self.starts[kept], counts)
        self.starts, self.counts, self.again = np.cumsum(counts) - counts, counts, np.zeros(len(kept), bool)
        self.known = {parts[i]: k for k, i in enumerate(kept.tolist())}

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return self._batches(self.tokenizer, texts)

    def _batches(self, tokenizer: Tokenizer, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for i in range(0, len(texts), AT_A_TIME):
            encoded = tokenizer.encode_batch_fast(texts[i : i + AT_A_TIME], add_special_tokens=False)
            out += [np.array(e.ids, np.uint32) for e in encoded]
        return out

    def _learn(self, parts: list[str]) -> None:
        """Encode new parts, each with a space before it."""
        ids, counts = self._encode_parts(parts)
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.again = np.concatenate([self.again, np.zeros(len(parts), bool)])
        self.ids = np.concatenate([self.ids, ids])
        self.known.update(zip(parts, range(len(self.known), len(self.known) + len(parts)), strict=True))

    def _encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts, each with a space before it, and the number of each."""
        text = " " + " ".join(parts)
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kind = self.kinds[np.minimum(code, len(self.kinds) - 1)]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        strange = kind == STRANGE
        at = np.flatnonzero(code[:-1] == ord("'"))
        strange[at[np.isin(code[at + 1], CONTRACTED)]] = True
        for token in self.added:
            i = text.find(token)
            while i >= 0:
                strange[i] = True
                i = text.find(token, i + 1)
        odd = np.logical_or.reduceat(strange, np.cumsum(sizes) - sizes)
        if not odd.any():
            return self._by_units(text, code, kind, sizes)

        out: list[np.ndarray] = []
        counts = np.empty(len(parts), np.int64)
        if not odd.all():
            rest = np.repeat(~odd, sizes)
            text = code[rest].tobytes().decode("utf-32-le")
            ids, counts[~odd] = self._by_units(text, code[rest], kind[rest], sizes[~odd])
            out.append(ids)
        alone = [parts[i] for i in np.flatnonzero(odd).tolist()]
        blocks = [alone[i : i + 500] for i in range(0, len(alone), 500)]
        encoded = self.whole([" " + " ".join(b) for b in blocks])
        out += encoded
        # widths tell whose tokens are whose
        ends = np.cumsum(self.widths[np.concatenate(encoded)])
        last = np.searchsorted(ends, np.cumsum([len(p.encode()) + 1 for p in alone])) + 1  # tokens up to and with the part
        counts[odd] = np.diff(last, prepend=0)
        # both in the order of the parts
        order = np.argsort(odd, kind="stable")
        starts = np.empty(len(parts), np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        return gathered(np.concatenate(out), starts, counts), counts

    def _by_units(self, text: str, code: np.ndarray, kind: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same by the tokenizer's own units (a word, a number, a run of signs or blanks), each encoded once.

        ``text`` holds the parts, ``sizes`` characters each with the space before them; no part starts with a blank.
        """
        border = np.ones(len(code), bool)
        border[1:] = (kind[1:] != kind[:-1]) & (kind[:-1] != SPACE)
        blank = kind == BLANK  # of a run of blanks before a word, the last is by itself
        border[1:-1] |= blank[1:-1] & blank[:-2] & ~blank[2:] & (kind[2:] != SPACE)
        at = np.flatnonzero(border)
        raw = text.encode()
        offsets = np.append(at, len(code))
        if len(raw) > len(code):
            offsets = np.concatenate([[0], np.cumsum(1 + (code >= 0x80) + (code >= 0x800))])[offsets]
        units = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw))
        distinct = units.dictionary_encode()
        pool, lengths = self._encode_units(distinct.dictionary)
        index = distinct.indices.to_numpy(zero_copy_only=False)
        counts = lengths[index]
        first = np.searchsorted(at, np.cumsum(sizes) - sizes)
        return gathered(pool, (np.cumsum(lengths) - lengths)[index], counts), np.add.reduceat(counts, first)

    def _encode_units(self, units: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units and the number of each."""
        offsets = np.frombuffer(units.buffers()[1], np.int64)[: len(units) + 1]
        raw = np.frombuffer(units.buffers()[2], np.uint8)[: offsets[-1]]
        text = np.insert(byte_characters()[raw], offsets[1:], ord(BORDER)).tobytes().decode("utf-32-le")
        begin = (offsets + np.arange(len(offsets)))[:-1:200].tolist()
        texts = [text[i:j] for i, j in zip(begin, [*begin[1:], len(text)], strict=True)]
        ids = np.concatenate(self._batches(self.unit_tokenizer, texts))
        own = ids != self.border
        return ids[own], np.diff(np.flatnonzero(~own), prepend=-1) - 1

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, each text's followed by END, and the number of each text's ids."""
        return next(self.blocks(pa.array(texts, pa.large_string()), [len(texts)]))

    def blocks(self, texts: pa.LargeStringArray, until: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same for blocks of texts, which end before the texts ``until``; the parts of all are looked up at once."""
        parts = pc.split_pattern(texts, " ")
        offsets = parts.offsets.to_numpy()
        distinct = parts.flatten().dictionary_encode()
        words = distinct.dictionary.to_numpy(zero_copy_only=False).tolist()
        index = distinct.indices.to_numpy(zero_copy_only=False)
        odd_word = pc.is_in(pc.utf8_slice_codeunits(distinct.dictionary, 0, 1), NO_WORD).to_numpy(zero_copy_only=False)
        keep = np.ones(len(index), bool)
        keep[offsets[:-1]] = False  # first parts; split() gives every text one
        odd_part = odd_word[index] & keep
        plain = ~np.logical_or.reduceat(odd_part, offsets[:-1]) if len(texts) else np.empty(0, bool)
        keep &= np.repeat(plain, np.diff(offsets))

        used = np.zeros(len(words), bool)
        used[index[keep]] = True
        if len(self.known) > CACHE:
            self._forget()
        place = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        self.again[place[used & (place >= 0)]] = True
        new = np.flatnonzero(used & (place < 0))
        if len(new):
            place[new] = len(self.known) + np.arange(len(new))
            self._learn([words[i] for i in new.tolist()])
        firsts = [words[i] for i in index[offsets[:-1]].tolist()]
        del parts, distinct, words  # the blocks need no more than the places

        for begin, end in zip([0, *until], until, strict=False):
            # first parts have no space before them, odd texts are whole: these are encoded by themselves
            heads = self.whole([firsts[i] if plain[i] else texts[i].as_py() for i in range(begin, end)])
            head_counts = np.array([len(h) for h in heads], np.int64)
            span = slice(offsets[begin], offsets[end])
            n = end - begin
            text_of = np.repeat(np.arange(n), np.diff(offsets[begin : end + 1]))[keep[span]]
            # rows of the output: per text its head, its other parts, the end token
            pool = np.concatenate([self.ids, *heads, np.array([END], np.uint32)])
            head_starts = len(self.ids) + np.cumsum(head_counts) - head_counts
            tail = place[index[span][keep[span]]]
            owner = np.concatenate([np.arange(n), text_of, np.arange(n)])
            order = np.argsort(owner, kind="stable")
            starts = np.concatenate([head_starts, self.starts[tail], np.full(n, len(pool) - 1)])[order]
            counts = np.concatenate([head_counts, self.counts[tail], np.ones(n, np.int64)])[order]
            yield gathered(pool, starts, counts), np.bincount(owner[order], counts, n).astype(np.int64)


def places_to_cut(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(T, penalty) of the places, ascending, from 0 to the last document end."""
    penalty = np.full(len(ids) + 1, -1, np.int64)
    penalty[np.flatnonzero(ends[ids]) + 1] = SENTENCE_CUT
    penalty[doc_ends] = 0
    penalty[0] = penalty[len(ids)] = 0
    at = np.flatnonzero(penalty >= 0)
    gaps = np.diff(at)
    extra = (gaps - 1) // STRETCH
    if extra.any():
        base = np.repeat(at[:-1], extra)
        step = np.arange(len(base)) - np.repeat(np.cumsum(extra) - extra, extra) + 1
        penalty[base + step * STRETCH] = OTHER_CUT
        at = np.flatnonzero(penalty >= 0)
    return at, penalty[at]


def best_cuts(at: list[int], penalty: list[int], size: int, last_cost: Callable[[int], int]) -> list[int]:
    """Cut positions, first and last place included, with the least padding and penalties.

    The last sequence costs ``last_cost`` of its length, as it is either
    continued or cut in its own way.
    """
    cost, back = [0] * len(at), [0] * len(at)
    queue = deque([(at[0], 0, at[0])])  # cost + T ascending from left to right
    for j in range(1, len(at) - 1):
        t = at[j]
        while t - queue[0][2] > size:
            queue.popleft()
        value, i, _ = queue[0]
        c = penalty[j] + size - t + value
        back[j] = i
        cost[j] = c
        c += t
        while queue and queue[-1][0] >= c:
            queue.pop()
        queue.append((c, j, t))
    end = len(at) - 1
    near = range(bisect_left(at, at[end] - size), end)
    back[end] = min(near, key=lambda i: cost[i] + last_cost(at[end] - at[i]))
    cuts = [end]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return [at[i] for i in reversed(cuts)]


def powers_cost(n: int, size: int) -> int:
    return min(size - n, (n.bit_count() - 1) * OTHER_CUT)


def powers(n: int, size: int) -> list[int]:
    """Lengths of the sequences for the last ``n`` tokens: powers of two, or one that is filled up."""
    if size - n <= (n.bit_count() - 1) * OTHER_CUT:
        return [n]
    return [1 << k for k in reversed(range(n.bit_length())) if n >> k & 1]


class Packer:
    """Turns a task's documents into pieces."""

    def __init__(self, ends: np.ndarray, size: int, first_sequence: int, with_ids: bool) -> None:
        self.ends, self.size, self.sequence, self.with_ids = ends, size, first_sequence, with_ids
        self.ids = np.empty(0, np.uint32)
        self.docs: list[tuple[int | None, int, int]] = []  # id, position of its first token (before 0: cut earlier), end

    def add(self, ids: np.ndarray, doc_ids: list[int | None], counts: np.ndarray) -> None:
        ends = len(self.ids) + np.cumsum(counts)
        self.docs += zip(doc_ids, (ends - counts).tolist(), ends.tolist(), strict=True)
        self.ids = np.concatenate([self.ids, ids])

    def flush(self, last: bool) -> pa.RecordBatch:
        """Pieces of all sequences but the last, whose tokens wait for more documents unless there are none."""
        cuts = [0]
        if len(self.ids):
            at, penalty = places_to_cut(self.ids, np.array([e for _, _, e in self.docs]), self.ends)
            last_cost = (lambda n: powers_cost(n, self.size)) if last else (lambda n: 0)
            cuts = best_cuts(at.tolist(), penalty.tolist(), self.size, last_cost)
            tail = cuts.pop() - cuts[-1]
            if last:
                cuts += (cuts[-1] + np.cumsum(powers(tail, self.size), dtype=np.int64)).tolist()
        rows: list[tuple] = []
        raw = self.ids.astype("<u4", copy=False)
        k = 0
        for start, end in zip(cuts, cuts[1:], strict=False):
            here = start
            while here < end:
                doc, first, doc_end = self.docs[k]
                until = min(end, doc_end)
                piece = raw[here:until].tobytes()
                rows.append(
                    (doc, here - first, until - here, zlib.crc32(piece), doc_end - first, self.sequence, here - start)
                    + ((piece,) if self.with_ids else ())
                )
                here = until
                k += until == doc_end
            self.sequence += 1
        gone = cuts[-1]
        self.ids = self.ids[gone:]
        self.docs = [(d, s - gone, e - gone) for d, s, e in self.docs[k:]]
        columns = list(zip(*rows, strict=True)) or [()] * (len(FIELDS) + self.with_ids)
        types = [pa.int64()] * len(FIELDS) + [pa.binary()] * self.with_ids
        names = [*FIELDS, *["ids"] * self.with_ids]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


FIELDS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, start (tokens of the document before it), length, ids_crc32 (of its ids as
    little-endian 32-bit numbers), doc_tokens (with the end token), sequence_id, offset (place in the sequence);
    ``with_ids`` adds the ids themselves, as those bytes.

    ``tokenizer`` is the path of a tokenizer file that every executor has. A
    null text counts as empty: one piece with the end token alone. Ids are
    passed through, null or repeated. sequence_id is unique: the number of the
    task times 2^33, plus a count. No rows move between tasks; a task that is
    run again yields the same pieces. Memory: a batch of texts and SEGMENT ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        packer = Packer(encoder.ends, size, TaskContext.get().partitionId() << 33, with_ids)
        for batch in batches:
            texts = batch.column(1)
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
            ends: list[int] = []  # of the blocks that are turned into ids at a time
            begin = 0
            while begin < len(texts):
                before = sizes[begin - 1] if begin else 0
                begin = max(begin + 1, int(np.searchsorted(sizes, before + CHARS, "right")))
                ends.append(begin)
            for k in range(0, len(ends), LOOKED_UP):
                begin = ends[k - 1] if k else 0
                until = ends[k : k + LOOKED_UP]
                some = pc.fill_null(texts.slice(begin, until[-1] - begin), "").cast(pa.large_string())
                for ids, counts in encoder.blocks(some, [e - begin for e in until]):
                    packer.add(ids, batch.column(0).slice(begin, len(counts)).to_pylist(), counts)
                    begin += len(counts)
                    if len(packer.ids) >= SEGMENT:
                        yield packer.flush(last=False)
        yield packer.flush(last=True)

    schema = ", ".join(f"{f} long" for f in FIELDS) + (", ids binary" if with_ids else "")
    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text").mapInArrow(giving_back(run), schema)
