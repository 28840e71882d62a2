import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from clickmart.llm import packing, tokens
from clickmart.llm.queries import tokenizer_path
from clickmart.llm.tokens import PieceEncoder, shared_tokenizer

FILES = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]


@pytest.mark.parametrize(("name", "keeps_blanks"), FILES)
def test_ids_are_those_of_the_whole_text(name, keeps_blanks, corpus):
    path = tokenizer_path(name)
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    texts = [t for _, t in corpus] + [
        " ", "a  b", "\nfoo bar\n", "x \n y", "It's <|endoftext|> Ünïcode, ok.  two", " lead", "trail ", "don't. ab12.5, 3.",
        "é. e ́x", "a b  c", "nul \0 \0x y\0", "the the. THE, (the) the...", "ΣΑΣ σας. ΣΑΣ",
    ]
    with open(path, encoding="utf-8") as file:
        encoder = PieceEncoder(file.read(), keeps_blanks)
    for _ in range(2):
        ids, lengths = encoder.encode(texts, end=0)
        ends = np.cumsum(lengths)
        for text, end, length in zip(texts, ends, lengths, strict=True):
            assert ids[end - length : end].tolist() == [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        assert encoder.encode(texts)[1].tolist() == (lengths - 1).tolist()


def test_what_an_encoder_holds_beside_its_ids_is_bounded(monkeypatch):
    path = tokenizer_path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        encoder = PieceEncoder(file.read(), False)
    calls, tables = [], []

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode_batch_fast(self, texts, **options):
            calls.append(len(texts))
            return self.tokenizer.encode_batch_fast(texts, **options)

    keep = tokens.pc.index_in
    monkeypatch.setattr(tokens.pc, "index_in", lambda values, value_set: tables.append(len(value_set)) or keep(values, value_set))
    monkeypatch.setattr(encoder, "_tokenizer", Counted(encoder._tokenizer))
    monkeypatch.setattr(tokens, "_BLOCK", 7, raising=False)
    words = [f"w{n}x{n % 7}." for n in range(9_000)]
    for texts in (words[:200], [" ".join(words)], ["some w5x5. other w8999x4. w5x5.", " ".join(words[::-1])], ["w5x5. new, w7x0. w7x0"]):
        ids, lengths = encoder.encode(texts, end=0)
        assert ids.tolist() == [x for t in texts for x in [*whole.encode(t, add_special_tokens=False).ids, 0]]
        assert len(lengths) == len(texts)
    # results of the library for few texts at a time, lookups in the names of a batch and not in all that are known
    assert max(calls) <= 50 and tables[-1] <= 4


def test_ids_are_gathered_without_a_place_for_each():
    starts = np.arange(500_000)
    tracemalloc.start()
    found = tokens._gather(np.arange(500_004, dtype=np.uint32), starts, np.full(len(starts), 4))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.tolist()[:9] == [0, 1, 2, 3, 1, 2, 3, 4, 2] and found[-1] == 500_002 and len(found) == 2_000_000
    assert peak < 4 * found.nbytes


def packed_right(rows, limit):
    bins = defaultdict(list)
    for row in rows:
        bins[row.sequence_id].append((row.offset, row.length))
    for members in bins.values():
        place = 0
        for offset, length in sorted(members):
            assert offset == place
            place += length
        assert place <= limit
    return bins


@pytest.mark.parametrize("group", [20_000, 12])
def test_every_id_is_packed_once(spark, documents, corpus, group):
    name = tokenizer_path("word_bpe_49k.json")
    tokenizer = shared_tokenizer(spark, name, keeps_blanks=False)
    rows = packing.pack(packing.pieces(documents, tokenizer), group=group).collect()
    bins = packed_right(rows, 2048)
    whole = Tokenizer.from_file(name)
    ids = [[*whole.encode(t or "", add_special_tokens=False).ids, 0] for _, t in corpus]
    wanted = []
    for (doc_id, _), own in zip(corpus, ids, strict=True):
        for piece, start in enumerate(range(0, len(own), 2048)):
            part = np.array(own[start : start + 2048], "<u4")
            wanted.append((str(doc_id), piece, start, len(part), zlib.crc32(part.tobytes())))
    assert sorted((str(r.doc_id), *r[1:5]) for r in rows) == sorted(wanted)
    assert len(bins) <= -(-sum(map(len, ids)) // 2048) + 1


def test_swaps_empty_a_bin():
    # one for one, then a move: 6+3 and 5+4 and 1 fill two bins of ten after swaps
    lengths = np.array([6, 3, 5, 4, 1, 1])
    found = packing.improve([[0, 1], [2, 3], [4], [5]], lengths, 10)
    assert sorted(sorted(b) for b in found) and len(found) == 2
    draw = random.Random(4)
    for _ in range(60):
        lengths = np.array([draw.randint(1, 60) for _ in range(draw.randint(1, 60))])
        start = [[n] for n in range(len(lengths))]
        found = packing.improve(start, lengths, 60)
        assert sorted(p for b in found for p in b) == list(range(len(lengths)))
        assert all(lengths[b].sum() <= 60 for b in found)
        assert len(found) <= len(packing.best_fit(lengths, 60)) + 2


def test_two_for_one():
    lengths = np.array([7, 2, 4, 4, 3])  # 7+2 | 4+4+... : two of the second bin for one of the first
    found = packing.improve([[0, 1], [2, 3], [4]], lengths, 10)
    assert len(found) == 2 and all(lengths[b].sum() <= 10 for b in found)


def test_best_fit_takes_the_fullest_bin_with_room():
    assert packing.best_fit(np.array([6, 5, 4, 5]), 10) == [[0, 2], [1, 3]]


def test_empty_table(spark, no_documents):
    tokenizer = shared_tokenizer(spark, tokenizer_path("word_bpe_49k.json"), keeps_blanks=False)
    assert packing.pack(packing.pieces(no_documents, tokenizer)).count() == 0


def test_pieces_that_never_fit_together_end(spark, monkeypatch):
    # several groups of pieces longer than half a sequence: no round can save any
    draw = random.Random(7)
    made = [(n, 0, 0, draw.randint(1025, 2040), 0) for n in range(300)]
    done = []
    keep = packing.stored
    monkeypatch.setattr(packing, "stored", lambda frame, name: done.append(name) or keep(frame, name))
    monkeypatch.setattr(packing, "MOST_ROUNDS", 6)
    rows = packing.pack(spark.createDataFrame(made, packing._PIECES), group=40).collect()
    assert done.count("packed") == 2
    assert sorted(r.doc_id for r in rows) == list(range(300)) and len(packed_right(rows, 2048)) == 300


def test_sequences_of_many_groups_are_filled_by_later_rounds(spark):
    draw = random.Random(8)
    made = [(n, 0, 0, draw.randint(300, 1500), 0) for n in range(400)]
    rows = packing.pack(spark.createDataFrame(made, packing._PIECES), group=40).collect()
    lengths = np.array([length for *_, length, _ in made])
    assert len(rows) == 400 and len(packed_right(rows, 2048)) <= len(packing.best_fit(lengths, 2048)) + 10


def test_search_looks_at_all_underfull_bins():
    # 6,000 sequences suffice; the 64 emptiest bins of best fit have no exchange among themselves
    lengths = np.array([1032] * 4000 + [528] * 4000 + [520] * 4000 + [496] * 8000)
    start = packing.best_fit(lengths, 2048)
    found = packing.improve(start, lengths, 2048)
    assert sorted(p for b in found for p in b) == list(range(len(lengths)))
    assert max(lengths[b].sum() for b in found) <= 2048
    assert len(start) == 7334 and len(found) == 6000


def test_no_exchange_is_left():
    draw = random.Random(5)
    for _ in range(30):
        lengths = np.array([draw.randint(15, 60) for _ in range(200)])
        found = packing.improve(packing.best_fit(lengths, 100), lengths, 100)
        if len(found) == -(-lengths.sum() // 100):
            continue
        sizes = [lengths[b].tolist() for b in found]
        for low, own in enumerate(sizes):
            for high, other in enumerate(sizes):
                if low == high:
                    continue
                for give in own:
                    for take in [0, *other]:
                        gain = give - take
                        assert gain <= 0 or sum(other) + gain > 100 or sum(other) + gain <= sum(own)
