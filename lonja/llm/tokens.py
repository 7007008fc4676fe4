"""Token ids of whole texts with a given public tokenizer, one Arrow batch at a time.

Byte-level BPE treats each pre-token on its own, and a pre-token always begins at a space between two visible
characters. So a text may be cut there, each distinct piece is encoded once per batch, and the ids are put
together by numpy. Texts in which a space touches other white space, or that hold an added token, are encoded as
they are.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lonja.llm.rows import byte_column, rows_by_bytes

#: Bytes of text whose distinct pieces are encoded together.
BATCH_BYTES = 8 << 20
#: Most pieces whose ids a worker process keeps from batch to batch, and the longest of them.
KEPT = 1_000_000
KEPT_LENGTH = 64
#: Strings that the tokenizer encodes at once: its results take some 180 bytes a token until they are read.
STRINGS = 32
#: Bytes of whole texts that it encodes at once.
WHOLE_BYTES = 256 << 10
_WHITE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: A space at either end of the text or beside other white space.
_UNEVEN = rf"^ | $| {_WHITE}|{_WHITE} "


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices ``values[start : start + length]`` one after the other."""
    total = int(lengths.sum())
    if total == 0:
        return values[:0]
    kind = np.int32 if max(total, len(values)) < 2**31 else np.int64
    # Each place is its slice's start plus its distance from the slice's first place in the result.
    shift = starts.astype(kind) - (np.cumsum(lengths) - lengths).astype(kind)
    place = np.repeat(shift, lengths)
    place += np.arange(total, dtype=kind)
    return values[place]


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker process and is shared by its tasks."""
    return sys.modules.setdefault("_lonja_worker_cache", ModuleType("_lonja_worker_cache")).__dict__


def shared_encoder(vocabulary: str, kept: int = KEPT, least: int = 1) -> "Encoder":
    """The worker process's encoder: what it learned about pieces in one task serves the next."""
    cache = worker_cache()
    if ("encoder", vocabulary, kept, least) not in cache:
        cache["encoder", vocabulary, kept, least] = Encoder(vocabulary, kept, least)
    return cache["encoder", vocabulary, kept, least]


def uneven(texts: pa.Array) -> np.ndarray:
    """Whether a space of the text stands at either end or beside other white space."""
    return pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False)


class Encoder:
    """Keeps the ids of up to ``kept`` pieces that occur ``least`` times in one batch."""

    def __init__(self, vocabulary: str, kept: int = KEPT, least: int = 1):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model, self.kept, self.least = Tokenizer.from_file(vocabulary), kept, least
        self.added = [token.content for token in self.model.get_added_tokens_decoder().values()]
        words = self.model.get_vocab(with_added_tokens=True)
        self.head = np.zeros(max(words.values()) + 1, bool)
        self.head[[i for word, i in words.items() if word.startswith("Ġ")]] = True
        self.known = pa.array([], pa.string())
        self.known_ids, self.known_lengths = np.zeros(0, np.int32), np.zeros(0, np.int32)

    def each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and their number for each text, by plain encoding."""
        found = [np.array(x.ids, np.int32) for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int32, len(found))
        return np.concatenate(found) if found else np.zeros(0, np.int32), lengths

    def spaced(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces without a space, each with one space before it.

        The pieces are encoded in long strings; a piece begins at each id whose bytes begin with a space.
        """
        n = len(pieces)
        if n == 0:
            return self.each([])
        cuts = pa.array(np.append(np.arange(0, n, 256), n), pa.int32())
        strings = pc.binary_join(pa.ListArray.from_arrays(cuts, pieces), " ").to_pylist()
        flats, lengths = [], []
        for at in range(0, len(strings), STRINGS):
            flat, _ = self.each([" " + x for x in strings[at : at + STRINGS]])
            heads = np.flatnonzero(self.head[flat])
            if len(heads) != min(256 * STRINGS, n - 256 * at):
                raise AssertionError("a piece does not begin at a space")
            flats.append(flat)
            lengths.append(np.diff(np.append(heads, len(flat))).astype(np.int32))
        return np.concatenate(flats), np.concatenate(lengths)

    def whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same as ``each`` for any number of texts, some at once."""
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        rows = pa.RecordBatch.from_arrays([texts], ["text"])
        found = [self.each(texts.slice(a, b - a).to_pylist()) for a, b in rows_by_bytes(rows, sizes, WHOLE_BYTES)] or [self.each([])]
        return np.concatenate([ids for ids, _ in found]), np.concatenate([lengths for _, lengths in found])

    def _pieces(self, pieces: pa.Array, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of distinct pieces that occur so many times, known ones by lookup."""
        place = pc.index_in(pieces, value_set=self.known)
        new = place.is_null().to_numpy(zero_copy_only=False)
        ids, lengths = self.spaced(pieces.filter(pa.array(new)))
        before = len(self.known)
        where = np.empty(len(pieces), np.int64)
        where[~new] = place.drop_null().to_numpy()
        where[new] = before + np.arange(int(new.sum()))
        all_lengths = np.concatenate([self.known_lengths, lengths])
        all_ids = np.concatenate([self.known_ids, ids])
        starts = np.cumsum(all_lengths, dtype=np.int64) - all_lengths
        result = ragged(all_ids, starts[where], all_lengths[where]), all_lengths[where]
        room = self.kept - before
        if room > 0 and len(lengths):
            fresh = pieces.filter(pa.array(new))
            keep = pc.less_equal(pc.binary_length(fresh), KEPT_LENGTH).to_numpy(zero_copy_only=False)
            keep = keep & (times[new] >= self.least)
            keep &= np.cumsum(keep) <= room
            self.known = pa.concat_arrays([self.known, fresh.filter(pa.array(keep))])
            first = np.cumsum(lengths) - lengths
            self.known_ids = np.concatenate([self.known_ids, ragged(ids, first[keep], lengths[keep])])
            self.known_lengths = np.concatenate([self.known_lengths, lengths[keep]])
        return result

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (none null) and the n + 1 offsets."""
        counts = np.zeros(len(texts), np.int64)
        apart = uneven(texts)
        for token in self.added:
            apart = apart | pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        odd, even = np.flatnonzero(apart), np.flatnonzero(~apart)
        odd_ids, odd_lengths = self.whole(texts.take(pa.array(odd)))
        lists = pc.split_pattern(texts.take(pa.array(even)) if len(odd) else texts, " ")
        offsets = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        index = coded.indices.to_numpy(zero_copy_only=False).copy()
        offsets = offsets - (offsets[0] if len(offsets) else 0)
        ids, lengths = self._pieces(coded.dictionary, np.bincount(index, minlength=len(coded.dictionary)))
        # The first piece of a text has no space before it: such pieces follow as more entries.
        firsts = offsets[:-1]
        unique, place = np.unique(index[firsts], return_inverse=True) if len(firsts) else (firsts, firsts)
        more, more_lengths = self.each(coded.dictionary.take(pa.array(unique)).to_pylist())
        index[firsts] = len(lengths) + place
        lengths = np.concatenate([lengths, more_lengths])
        ids = np.concatenate([ids, more])
        starts = np.cumsum(lengths) - lengths
        piece_lengths = lengths[index]
        flat = ragged(ids, starts[index], piece_lengths)
        ends = np.concatenate([[0], np.cumsum(piece_lengths)])[offsets]
        counts[even] = np.diff(ends)
        counts[odd] = odd_lengths
        at = np.concatenate([[0], np.cumsum(counts)])
        if not len(odd):
            return flat, at
        both = np.concatenate([flat, odd_ids])
        begin = np.zeros(len(texts), np.int64)
        begin[even] = ends[:-1]
        begin[odd] = len(flat) + np.cumsum(odd_lengths) - odd_lengths
        return ragged(both, begin, counts), at


def gathered(batches: Iterator[pa.RecordBatch], column: int, size_of_batch: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of about ``size_of_batch`` bytes of text, whatever the size of the incoming ones."""
    held, size = [], 0
    for batch in batches:
        _, at = byte_column(batch.column(column))
        for start, stop in rows_by_bytes(batch, np.diff(at), size_of_batch):
            held.append(batch.slice(start, stop - start))
            size += int(at[stop] - at[start])
            if size >= size_of_batch:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if held:
        whole = pa.Table.from_batches(held).combine_chunks()
        yield from whole.to_batches()
