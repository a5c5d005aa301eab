"""Best-fit-decreasing packing of tokenised documents into sequences.

Documents are tokenised (ids, then `END`); only those longer than a sequence are cut. Pieces are dealt by hash to groups
of about `GROUP_PIECES`, and each group is packed by itself: pieces from long to short, each into the open sequence with
the least room that still fits, found in a segment tree over remaining capacities. A group leaves a sequence or two
half full, whatever the size of the corpus. Order within a group does not depend on how rows arrive.

Null and empty texts are one piece that holds `END` alone. Repeated rows are packed each for itself. Null ids are kept.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, stage, steps, table, utf8

END, SEQUENCE, GROUP_PIECES = 0, 2048, 20_000
#: What the vocabulary encodes by itself, in lower-case ASCII.
UNITS = "'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+"


class WordEncoder:
    """Token ids of white-space-separated words; the first `MOST` words ever met are remembered, as one Arrow column.

    The vocabulary never joins words over white space, nor units of a word (runs of letters, single digits, runs of anything
    else), so words are looked up one by one, and new ones are encoded many at a time. Ids of a unit end with a token that
    ends in `</w>`.
    """

    MOST, LINE = 100_000, 200

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # for units of lower-case ASCII, which normalisation leaves as they are; it shares the vocabulary
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True
        self.words = pa.array([], pa.string())
        self.starts, self.lengths, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, "<u4")

    def lookup(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and number of the ids of each of some distinct words, and the ids that these are places of."""
        place = pc.index_in(words, value_set=self.words)
        fresh = place.is_null()
        new = words.filter(fresh)
        starts, lengths, ids = self._encoded(new)
        fresh = fresh.to_numpy(zero_copy_only=False)
        place = np.where(fresh, len(self.words) - 1 + np.cumsum(fresh), place.fill_null(0).to_numpy())
        room = self.MOST - len(self.words)
        held = np.concatenate([self.starts, starts + len(self.ids)]), np.concatenate([self.lengths, lengths]), np.concatenate([self.ids, ids])
        if room > 0 and len(new):
            self.words = pa.concat_arrays([self.words, new[:room]])
            own = gathered(ids, starts[:room], lengths[:room])
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths[:room], dtype=np.int64) - lengths[:room]])
            self.lengths, self.ids = held[1][: len(self.words)], np.concatenate([self.ids, own])
        return held[0][place], held[1][place], held[2]

    def _encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words with their units set apart by spaces go to the tokenizer, and their ids are counted off by units. Where that
        can't be told beforehand, or the count differs, the tokenizer says which characters each id stands for, which takes
        it longer."""
        lower = pc.and_not(pc.equal(words, pc.ascii_lower(words)), pc.match_substring(words, "<|"))
        lower = pc.and_(pc.and_(lower, pc.string_is_ascii(words)), pc.utf8_is_printable(words))
        letters = pc.and_(lower, pc.ascii_is_alpha(words))
        lower = pc.and_not(lower, letters)
        other = np.flatnonzero(pc.invert(pc.or_(letters, lower)))
        rest = words.take(other)
        tailed = pc.replace_substring_regex(rest, r"^(\p{L}+)([!-&(-/:-@\[-`{-~]+)$", r"\1 \2")
        known = pc.or_(pc.utf8_is_alpha(rest), pc.not_equal(pc.binary_length(tailed), pc.binary_length(rest))).to_numpy(zero_copy_only=False)
        apart = pc.ascii_rtrim_whitespace(pc.replace_substring_regex(words.filter(lower), f"({UNITS})", r"\1 "))
        groups = [(self.plain, letters, words.filter(letters)), (self.plain, lower, apart)]
        groups = [(t, np.flatnonzero(rows), spaced) for t, rows, spaced in groups] + [(self.tokenizer, other[known], tailed.filter(known))]
        starts, lengths, parts, done, left = np.zeros(len(words), np.int64), np.zeros(len(words), np.int32), [], 0, [other[~known]]

        def keep(rows: np.ndarray, ids: np.ndarray, cuts: np.ndarray) -> None:
            nonlocal done
            starts[rows], lengths[rows] = done + cuts[:-1], np.diff(cuts)
            parts.append(ids)
            done += len(ids)

        for tokenizer, rows, spaced in groups:
            last = np.cumsum(pc.count_substring(spaced, " ").to_numpy() + 1)
            for at, line in _lines(spaced, self.LINE):
                own, until = rows[at : at + self.LINE], last[at : at + self.LINE] - (last[at - 1] if at else 0)
                ids = np.array(tokenizer.encode_batch_fast([line], add_special_tokens=False)[0].ids, "<u4")
                ends = np.flatnonzero(self.ends[ids]) + 1
                if len(ends) == until[-1]:
                    keep(own, ids, np.concatenate([[0], ends[until - 1]]))
                else:
                    left.append(own)
        left = np.concatenate(left)
        for at, line in _lines(words.take(pa.array(left)), self.LINE):
            own = left[at : at + self.LINE]
            made = self.tokenizer.encode(line, add_special_tokens=False)
            begins = np.cumsum([0, *(len(w) + 1 for w in line.split(" "))])
            keep(own, np.array(made.ids, "<u4"), np.searchsorted([o[0] for o in made.offsets], begins))
        return starts, lengths, np.concatenate([np.zeros(0, "<u4"), *parts])


def _lines(words: pa.Array, size: int) -> Iterator[tuple[int, str]]:
    """Words joined by spaces, `size` a line, and the place of each line's first word."""
    places = [*range(0, len(words), size), len(words)]
    if len(words):
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(places, pa.int32()), words), " ")
        yield from ((at, line.as_py()) for at, line in zip(places, joined))


def gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of `values` that begin at `starts`, one after the other."""
    ends = np.cumsum(lengths, dtype=np.int64)
    places = np.repeat(starts - ends + lengths, lengths)
    places += np.arange(len(places))
    return values[places]


def _words(texts: pa.Array) -> pa.ListArray:
    """Lower-cased words; texts that may hold special tokens stay as they are."""
    texts = texts.cast(pa.string()).fill_null("")
    return pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts)))


def pieces(docs: DataFrame, tokenizer: str, end: int = END, size: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, the ids; `spread` tells equal rows of a batch apart."""

    def step(batch, encoder):
        offsets = utf8(batch.column("text"))[1]
        mark, made_before = np.array([end], "<u4").tobytes(), 0
        for first, last in steps(offsets, 2 << 20):
            row, parts = [], []
            words = _words(batch.column("text").slice(first, last - first))
            found = words.flatten().dictionary_encode()
            starts, lengths, held = encoder.lookup(found.dictionary)
            each = found.indices.to_numpy()
            ends = np.concatenate([[0], np.cumsum(lengths[each], dtype=np.int64)])[words.offsets.to_numpy() - words.offsets[0].as_py()]
            made_ids = gathered(held, starts[each], lengths[each])
            for k, low, high in zip(range(first, last), ends[:-1], ends[1:], strict=True):
                ids = made_ids[low:high].tobytes() + mark
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    row.append(k)
                    parts.append((piece, at // 4, ids[at : at + 4 * size]))
            made = {
                "doc_id": batch.column("doc_id").take(np.array(row, np.int64)),
                "piece": [p[0] for p in parts],
                "start": [p[1] for p in parts],
                "length": [len(p[2]) // 4 for p in parts],
                "ids_crc32": [zlib.crc32(p[2]) for p in parts],
                "spread": made_before + np.arange(len(parts)),
            }
            made_before += len(parts)
            yield made | ({"ids": [np.frombuffer(p[2], "<u4").astype(np.int32) for p in parts]} if with_ids else {})

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, spread long" + ", ids array<int>" * with_ids
    return map_batches(docs.select("doc_id", "text"), step, schema, lambda: WordEncoder(tokenizer))


class Rooms:
    """Open sequences by remaining room: a segment tree that counts them, and the sequences of each room."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._add(room, 1)

    def tightest(self, need: int) -> int | None:
        """The least room of `need` or more."""
        node = self.leaves + need
        if self.count[node]:
            return need
        while node > 1 and (node & 1 or not self.count[node + 1]):
            node >>= 1
        if node <= 1:
            return None
        node += 1
        while node < self.leaves:
            node = 2 * node + (not self.count[2 * node])
        return node - self.leaves

    def take(self, room: int) -> int:
        self._add(room, -1)
        return self.open[room].pop()


def best_fit(lengths: list[int], size: int) -> tuple[list[int], list[int]]:
    """Sequence and place of each piece; lengths come in falling order."""
    rooms, sequence, offset, opened = Rooms(size), [], [], 0
    for length in lengths:
        room = rooms.tightest(length)
        if room is None:
            room, number = size, opened
            opened += 1
        else:
            number = rooms.take(room)
        sequence.append(number)
        offset.append(size - room)
        if room > length:
            rooms.put(room - length, number)
    return sequence, offset


def pack(made: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """`made` (as `pieces` returns it) with sequence_id and offset."""
    groups = -(-made.count() // GROUP_PIECES) or 1
    columns = [c for c in made.columns if c != "spread"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in made.schema if f.name in columns) + ", sequence_id long, offset long"

    def solve(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32", "spread"], ascending=[False, True, True, True, True], kind="stable")
        sequence, offset = best_fit(rows["length"].tolist(), size)
        return rows[columns].assign(sequence_id=np.array(sequence, np.int64) + (int(key[0]) << 32), offset=offset)

    group = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "spread"), F.lit(groups))
    return made.groupBy(group).applyInPandas(solve, schema)


def pack_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack(stage(pieces(docs, str(tokenizer)), "pieces"))


def op6_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
