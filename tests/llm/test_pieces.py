import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm.pieces import Vocabulary, decode, decoded, encode, encoded, load, normalised, viterbi
from tessera.llm.queries import PIECES

V = load(PIECES)


def as_unigram(path):
    """The library's own Viterbi on the same pieces: the model file with the other model type."""
    import sentencepiece

    raw = bytearray(open(path, "rb").read())

    def fields(lo, hi):
        def number(i):
            x = s = 0
            while True:
                c = raw[i]
                x, s, i = x | (c & 127) << s, s + 7, i + 1
                if c < 128:
                    return x, i

        while lo < hi:
            tag, lo = number(lo)
            if tag & 7 == 0:
                start, (_, lo) = lo, number(lo)
            else:
                n, start = number(lo) if tag & 7 == 2 else ({5: 4, 1: 8}[tag & 7], lo)
                lo = start + n
            yield tag >> 3, start, lo

    for f, lo, hi in list(fields(0, len(raw))):
        if f == 2:
            for g, start, _ in list(fields(lo, hi)):
                if g == 3:
                    raw[start] = 1
    return sentencepiece.SentencePieceProcessor(model_proto=bytes(raw))


def test_same_score_as_the_library(spark):
    """The best of the library's n-best list (its plain call loses digits to scores of -1e9 in single precision)."""
    lib = as_unigram(PIECES)
    words = {w for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect() for w in r.text.split()}
    total = lambda ids: sum(V.words[V.text[i]][1] for i in ids)
    for w in sorted(words)[:3000]:
        best = lib.nbest_encode_as_ids(w, 2)[0]
        if not {*best} & {*V.bytes}:
            ids = encode(w, V, {})
            assert ids == best or total(ids) == total(best)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\tabehnt.éß日"), st.characters(exclude_characters="▁", exclude_categories=["Cs"])), max_size=80))
def test_round_trip_and_streaming(text):
    ids = encode(text, V, {})
    assert decode(ids, V) == text
    assert [i for part in viterbi(normalised(text, V), V) for i in part] == ids


def brute(text, v):
    best = [(0.0, [])] + [None] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(j):
            p = v.words.get(text[i:j])
            if p is None and j == i + 1:
                p = (-1, v.least - 10)
            if p and best[i] and (best[j] is None or best[i][0] + p[1] > best[j][0]):
                best[j] = (best[i][0] + p[1], [*best[i][1], v.unknown if p[0] < 0 else p[0]])
    return best[-1][1]


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.text(alphabet="ab▁", min_size=1, max_size=5), st.integers(-9, -1), min_size=1, max_size=12), st.text(alphabet="ab▁", max_size=60))
def test_any_vocabulary_against_all_segmentations(words, text):
    """Also pieces with inner spaces, and paths that meet late."""
    v = Vocabulary({w: (n, float(s)) for n, (w, s) in enumerate(words.items())}, [], list(words), 99, False)
    got = [i for part in viterbi(text, v) for i in part]
    want = brute(text, v)
    merged = lambda x: [i for n, i in enumerate(x) if i != 99 or n == 0 or x[n - 1] != 99]
    assert merged(got) == merged(want)


def test_stream_is_settled_early():
    parts = list(viterbi("x" * 30_000 + "the▁" * 5_000, V))
    assert len(parts) > 1_000 and max(map(len, parts)) < 100


@pytest.mark.parametrize("ids", [[], [1, 2, 0], [10**6, -1], [V.bytes[0xC3]] if V.bytes else []])
def test_decoding_odd_ids(ids):
    assert decode(ids, V) in ("", "�")


def test_frames(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (2, "", "a"), (3, "word " * 50_000, None)], "doc_id long, text string, ids string")
    out = decoded(encoded(df, PIECES), PIECES, into="back").collect()
    assert [(r.doc_id, r.back) for r in out] == [(r.doc_id, r.text) for r in df.collect()]
    assert out[0].ids is None and out[1].ids == [] and len(out[3].ids) >= 50_000
    assert encoded(df.limit(0), PIECES).count() == 0
