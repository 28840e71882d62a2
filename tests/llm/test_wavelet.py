import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from clickmart.llm import wavelet
from clickmart.llm.queries import tokenizer_path
from clickmart.llm.tokens import shared_tokenizer


@pytest.mark.parametrize("top", [1, 5, 700, 50_257, 200_000])
def test_access_rank_select(top):
    draw = random.Random(top)
    ids = np.array([min(top, int(draw.paretovariate(0.4))) for _ in range(1500)], np.uint32)
    matrix = wavelet.WaveletMatrix(wavelet.write_matrix(ids, [3, None], [1000, 500]))
    assert matrix.doc_ids == [3, None] and matrix.lengths.tolist() == [1000, 500]
    assert (matrix.all_ids() == ids).all()
    for place in draw.sample(range(1500), 60):
        token = int(ids[place])
        assert matrix.access(place) == token
        places = np.flatnonzero(ids == token)
        assert matrix.rank(token, place) == (places < place).sum() and matrix.count(token) == len(places)
        n = draw.randrange(len(places))
        assert matrix.select(token, n) == places[n] and matrix.select(token, len(places)) == -1
    assert matrix.occurrences(int(ids[7])) == np.flatnonzero(ids == ids[7]).tolist()
    assert matrix.count(top + 1) == 0 and matrix.count(1 << 30) == 0
    with pytest.raises(IndexError):
        matrix.access(1500)


def test_empty_matrix_and_other_files():
    matrix = wavelet.WaveletMatrix(wavelet.write_matrix([], [], []))
    assert matrix.tokens == 0 and matrix.count(0) == 0 and len(matrix.all_ids()) == 0
    with pytest.raises(ValueError, match="wavelet"):
        wavelet.WaveletMatrix(b"something else")


@pytest.mark.parametrize("file_tokens", [8_000_000, 3_000])
def test_round_trip(spark, documents, corpus, file_tokens):
    name = tokenizer_path("byte_bpe_50k.json")
    folder = wavelet.new_folder(spark)
    shards = wavelet.write_shards(documents, folder, shared_tokenizer(spark, name, keeps_blanks=True), file_tokens=file_tokens)
    rows = wavelet.read_shards(spark, folder, shards).collect()
    whole = Tokenizer.from_file(name)
    wanted, start = [], 0
    for doc_id, text in sorted(corpus, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        wanted.append((str(doc_id), start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((str(r[0]), *r[1:]) for r in rows) == sorted(wanted)


def test_empty_table(spark, no_documents):
    folder = wavelet.new_folder(spark)
    shards = wavelet.write_shards(no_documents, folder, shared_tokenizer(spark, tokenizer_path("byte_bpe_50k.json"), True))
    assert shards.count() == 0
