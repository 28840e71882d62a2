import hashlib

import pytest
import xxhash

from clickmart.llm.imatch import compare_edits, lexicon, likeness


@pytest.fixture(scope="module")
def rows(documents):
    return compare_edits(documents, lexicon(documents, low=0.05)).collect()


def test_edits_are_those_of_the_next_document(rows, corpus):
    order = sorted(corpus, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    wanted = []
    for (doc_id, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        wanted.append((str(doc_id), len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in rows) == sorted(wanted)


def test_equal_texts_have_equal_fingerprints_and_likeness_is_a_share(rows, corpus):
    texts = {}
    for doc_id, text in corpus:
        texts.setdefault(text or "", set()).add(doc_id)
    prints = {r.doc_id: r.fingerprint for r in rows}
    for ids in texts.values():
        assert len({prints[i] for i in ids}) == 1
    assert len(set(prints.values())) > 40
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert sum(r.near_edited for r in rows) > sum(r.near_next for r in rows)
    assert all(r.near_edited == 1 for r in rows if r.fingerprint == r.edited_fingerprint)


def test_lexicon_is_the_band(documents, corpus):
    df = {}
    for _, text in corpus:
        for word in set((text or "").lower().encode().split()):
            df[word] = df.get(word, 0) + 1
    inside = [w for w, n in df.items() if 0.05 * len(corpus) <= n <= 0.2 * len(corpus)]
    assert len(lexicon(documents, low=0.05)) == len(inside)
    assert lexicon(documents, low=0.05).tolist() == sorted(map(xxhash.xxh3_64_intdigest, inside))


def mixed(n):
    n = (n ^ (n >> 31)) * 0xBF58476D1CE4E5B9 % 2**64
    n = (n ^ (n >> 29)) * 0x94D049BB133111EB % 2**64
    return n ^ (n >> 32)


def brute_print(text, band):
    """The fingerprint term by term: its 17 subsets, and the hash of each as a sum over its sorted terms."""
    odd = 0x9E3779B97F4A7C15
    terms = {xxhash.xxh3_64_intdigest(word) for word in text.encode().lower().split()}
    terms = sorted(terms & band or terms)
    marks = []
    for n, halvings in enumerate([0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 6, 6, 7, 7, 8, 8]):
        rate = min(2**64 >> halvings, 2**64 - 1)
        chosen = [t for t in terms if mixed((t + (2 * n + 1) * odd) % 2**64) < rate]
        value = sum(t * pow(odd, place + 1, 2**64) for place, t in enumerate(chosen)) % 2**64
        marks.append(mixed(value) | 1 if chosen else 0)
    return marks


def brute_likeness(left, right):
    either = [(a, b) for a, b in zip(left, right, strict=True) if a or b]
    return sum(a == b for a, b in either) / len(either) if either else 1.0


def test_fingerprints_and_likeness_equal_brute_force(rows, documents, corpus):
    df = {}
    for _, text in corpus:
        for word in set((text or "").encode().lower().split()):
            df[word] = df.get(word, 0) + 1
    band = {xxhash.xxh3_64_intdigest(w) for w, n in df.items() if max(2, 0.05 * len(corpus)) <= n <= 0.2 * len(corpus)}
    order = sorted(corpus, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    wanted = []
    for (doc_id, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        cut = len(text) // 3
        own, edited, following = (brute_print(t, band) for t in (text, text[: len(text) - cut] + after[:cut], after))
        prints = ["-".join(f"{mark >> 32:08x}" if mark else "0" for mark in marks) for marks in (own, edited)]
        wanted.append((str(doc_id), *prints, brute_likeness(own, edited), brute_likeness(own, following)))
    found = [(str(r.doc_id), r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in rows]
    assert sorted(found) == sorted(wanted)


def test_one_row_and_none(spark, no_documents):
    assert compare_edits(no_documents, lexicon(no_documents)).count() == 0
    row = compare_edits(spark.createDataFrame([(5, "abcdef")], "doc_id long, text string"), lexicon(no_documents)).collect()
    assert [(r.doc_id, r.edited_sha256) for r in row] == [(5, hashlib.sha256(b"abcdab").hexdigest())]
