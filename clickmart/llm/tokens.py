"""Ids of texts by the tokenizers library, each distinct piece between blanks encoded once per worker."""

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KNOWN_BYTES = 80 << 20
_TAIL = ".,;:!?"
_RUN = 100
_CALL = 50
_BLOCK = 1 << 17


def shared_tokenizer(spark, path, keeps_blanks):
    """A tokenizer file (a few MB, whatever the data) as a broadcast for ``encoder_of``."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast({"definition": file.read(), "keeps_blanks": keeps_blanks})


def encoder_of(shared):
    """The worker's encoder, kept beside the broadcast value for as long as the worker lives."""
    box = shared.value
    if "encoder" not in box:
        box["encoder"] = PieceEncoder(box["definition"], box["keeps_blanks"])
    return box["encoder"]


def _strings(texts):
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())


def _numbers(column):
    return column.to_numpy(zero_copy_only=False)


def _gather(flat, starts, sizes):
    """``sizes`` values of ``flat`` from each start, one after the other; places are made for ``_BLOCK`` starts at a time."""
    found, done = np.empty(sizes.sum(), flat.dtype), 0
    for n in range(0, len(sizes), _BLOCK):
        some = sizes[n : n + _BLOCK]
        at = np.repeat(starts[n : n + _BLOCK] - (np.cumsum(some) - some), some)
        at += np.arange(len(at))
        found[done : done + len(at)] = flat[at]
        done += len(at)
    return found


class PieceEncoder:
    """Encodes texts with a tokenizer file whose tokens never span a blank between two other characters.

    A text is cut at its blanks. A piece that neither begins nor ends with white space is encoded once (with its
    leading blank where the tokenizer keeps blanks) and remembered; letters and the punctuation after them never share a
    token, so each is looked up. When more than ``KNOWN_BYTES`` are known the memory starts anew. A text with any other
    piece goes to the tokenizer whole, so that the ids are always those of the whole text. Texts that hold names of
    special tokens are ordinary texts. Pieces are split, made distinct and looked up as Arrow arrays.
    """

    def __init__(self, definition, keeps_blanks):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_str(definition)
        self._tokenizer.encode_special_tokens = True
        self._blank = " " if keeps_blanks else ""
        between = f" \0{'' if keeps_blanks else ' '}"
        one, two = self._many([f"{self._blank}a", f"{self._blank}a{between}{self._blank}a"])
        self._between, self._mark = between, two[len(one) : -len(one)]
        self._forget()

    def _forget(self):
        self._names, self._tails = pa.array([], pa.large_string()), {}
        self._flat, self._starts, self._sizes = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _many(self, texts):
        """The ids of each text, ``_CALL`` texts to a call: what the library returns takes over a hundred bytes a token."""
        for n in range(0, len(texts), _CALL):
            for found in self._tokenizer.encode_batch_fast(texts[n : n + _CALL], add_special_tokens=False):
                yield found.ids

    def _separate(self, pieces):
        """Arrays of ids, and the number of ids of each piece: many pieces to a call, with a NUL character between them."""
        runs = [pieces[n : n + _RUN] for n in range(0, len(pieces), _RUN)]
        flat, sizes = [], []
        texts = [self._between.join(run) for run in runs]
        for run, text, ids in zip(runs, texts, self._many(texts), strict=True):
            ids = np.array(ids, np.uint32)
            ends = np.flatnonzero(ids == self._mark[-1]) + 1
            if len(ends) == text.count("\0") == len(run) - 1:
                marks = (ends[:, None] - np.arange(1, len(self._mark) + 1)).reshape(-1)
                flat.append(np.delete(ids, marks))
                sizes.append(np.diff(ends - len(self._mark), prepend=0, append=len(ids)) - len(self._mark) * (np.arange(len(run)) > 0))
            else:
                rows = [np.array(row, np.uint32) for row in self._many(run)]
                flat += rows
                sizes.append(np.fromiter(map(len, rows), np.int64, len(rows)))
        return flat, np.concatenate(sizes)

    def _keep(self, flat, sizes):
        """Adds ids to the bank; where those of each piece begin."""
        starts = len(self._flat) + np.cumsum(sizes) - sizes
        self._flat = np.concatenate([self._flat, *flat])
        return starts

    def _numbers_of(self, names):
        """Places of distinct names among the known ones; learns the others.

        The known ones are looked up among ``names``, so that the table made for it is as large as a batch needs.
        """
        found = _numbers(pc.fill_null(pc.index_in(self._names, value_set=names), -1))
        known = np.flatnonzero(found >= 0)
        places = np.full(len(names), -1, np.int64)
        places[found[known]] = known
        new = names.filter(pa.array(places < 0))
        if len(new):
            places[places < 0] = len(self._names) + np.arange(len(new))
            flat, sizes = self._separate([self._blank + name for name in new.to_pylist()])
            self._starts = np.concatenate([self._starts, self._keep(flat, sizes)])
            self._sizes = np.concatenate([self._sizes, sizes])
            self._names = pa.concat_arrays([self._names, new])
        return places

    def _tail(self, tail):
        if tail not in self._tails:
            ids = np.array(next(self._many([tail])), np.uint32)
            self._tails[tail] = self._keep([ids], np.array([len(ids)]))[0], len(ids)
        return self._tails[tail]

    def _entries(self, pieces):
        """Of distinct pieces: which can't be encoded alone; the ids of the others in a row; the number of each one's ids."""
        ends = pc.or_(pc.utf8_is_space(pc.utf8_slice_codeunits(pieces, 0, 1)), pc.utf8_is_space(pc.utf8_slice_codeunits(pieces, -1)))
        apart = pc.or_(ends, pc.equal(pc.binary_length(pieces), 0))
        good = pieces.filter(pc.invert(apart))
        cores = pc.utf8_rtrim(good, characters=_TAIL)
        cut = _numbers(pc.subtract(pc.binary_length(good), pc.binary_length(cores)))
        parted = (cut > 0) & _numbers(pc.utf8_is_alpha(pc.utf8_slice_codeunits(cores, -1)))
        names = pc.if_else(pa.array(parted), cores, good).dictionary_encode()
        at = self._numbers_of(names.dictionary)[_numbers(names.indices)]
        starts, sizes = np.zeros((len(good), 2), np.int64), np.zeros((len(good), 2), np.int64)
        starts[:, 0], sizes[:, 0] = self._starts[at], self._sizes[at]
        for size in np.unique(cut[parted]).tolist():
            rows = np.flatnonzero(parted & (cut == size))
            tails = pc.utf8_slice_codeunits(good.take(pa.array(rows)), -size).dictionary_encode()
            known = np.array([self._tail(tail) for tail in tails.dictionary.to_pylist()], np.int64)
            starts[rows, 1], sizes[rows, 1] = known[_numbers(tails.indices)].T
        apart = _numbers(apart)
        counts = np.zeros(len(pieces), np.int64)
        counts[~apart] = sizes.sum(1)
        return apart, _gather(self._flat, starts.reshape(-1), sizes.reshape(-1)), counts

    def encode(self, texts, end=None):
        """All ids of ``texts`` (None counts as empty) in one array and the number per text; ``end`` closes each text."""
        if self._names.nbytes + self._flat.nbytes + 2 * self._sizes.nbytes > KNOWN_BYTES:
            self._forget()
        texts = _strings(texts)
        filled = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False)
        places = np.flatnonzero(_numbers(filled))
        lengths = np.zeros(len(texts), np.int64)
        flat, edges, whole = np.empty(0, np.uint32), np.zeros(1, np.int64), np.zeros(0, bool)
        if len(places):
            flat, edges, whole = self._encode(texts.filter(filled))
        if whole.any():
            rows = [flat[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            for row in np.flatnonzero(whole).tolist():
                rows[row] = np.array(next(self._many([texts[places[row]].as_py()])), np.uint32)
            flat, edges = np.concatenate(rows), np.cumsum([0, *map(len, rows)])
        lengths[places] = np.diff(edges)
        if end is None:
            return flat, lengths
        return np.insert(flat, np.cumsum(lengths), end), lengths + 1

    def _encode(self, texts):
        """Ids of texts that are not empty, where each text's ids begin and end, and which texts must be encoded whole."""
        parts = pc.split_pattern(texts, " ")
        edges = _numbers(parts.offsets).astype(np.int64)
        edges -= edges[0]
        pieces = parts.flatten().dictionary_encode()
        codes = _numbers(pieces.indices).copy()
        # The first piece of a text has no blank before it and may begin with other white space.
        firsts = parts.flatten().take(pa.array(edges[:-1])).dictionary_encode()
        apart, flat, counts = self._entries(pieces.dictionary)
        first_apart = _numbers(pc.or_(pc.equal(pc.binary_length(firsts.dictionary), 0),
                                      pc.utf8_is_space(pc.utf8_slice_codeunits(firsts.dictionary, -1))))
        first_ids = [np.array(ids, np.uint32) for ids in self._many(firsts.dictionary.to_pylist())]
        codes[edges[:-1]] = len(counts) + _numbers(firsts.indices)
        apart = np.concatenate([apart, first_apart])
        counts = np.concatenate([counts, np.fromiter(map(len, first_ids), np.int64, len(first_ids))])
        flat = np.concatenate([flat, *first_ids])
        starts = np.cumsum(counts) - counts
        sizes = counts[codes]
        ends = np.concatenate(([0], np.cumsum(sizes)))[edges]
        return _gather(flat, starts[codes], sizes), ends, np.logical_or.reduceat(apart[codes], edges[:-1])
