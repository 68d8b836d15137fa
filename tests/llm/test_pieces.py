import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import pieces as p


def greedy(vocabulary, word):
    """Longest match from the left, again and again."""
    text, n = p.MARK + word, 0
    while text:
        size = max((i for i in range(1, len(text) + 1) if text[:i] in vocabulary), default=0)
        if not size:
            return 0
        text, n = text[size:], n + 1
    return n


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("ab▁c", min_size=1, max_size=4), max_size=15), st.text("abcd", max_size=12))
def test_automaton_is_greedy(vocabulary, word):
    assert p.Automaton(sorted(vocabulary)).count(word) == greedy(vocabulary, word)


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return {model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}


def test_query(spark, tables, vocabulary):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    rows = p.op8_token_counts(spark, tables).collect()
    assert len(rows) == len(texts)
    known = {}
    for r in rows:
        words = texts[r.doc_id].split()
        counts = [known[w] if w in known else known.setdefault(w, greedy(vocabulary, w)) for w in words]
        assert (r.n_words, r.n_unknown, r.n_pieces) == (len(words), counts.count(0), sum(counts) + counts.count(0))


def test_messy(messy, empty, vocabulary):
    rows = {r.doc_id: r for r in p.count_pieces(messy).collect()}
    assert (rows[2].n_words, rows[2].n_pieces) == (0, 0) and rows[4].n_words == 0 and rows[5].n_words == 160_000
    assert p.count_pieces(messy).count() == messy.count() and p.count_pieces(empty).count() == 0


def test_very_long_word_is_linear():
    automaton = p.Automaton(["▁", "a", "aa", "aaaaaaaaab"])
    assert automaton.count("a" * 200_000) > 0
