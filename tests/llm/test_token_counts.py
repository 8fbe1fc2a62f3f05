from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orelake.llm.token_counts import _pretokens, default_vocabulary, token_counts
from tests.llm.helpers import empty, make, nasty, text


def test_counts_equal_the_library(spark):
    rows = nasty() + [(30 + i, text(i, 80, 50) + " the" * 70_000 * (i == 0)) for i in range(4)]
    lib = Tokenizer.from_file(default_vocabulary())
    want = sorted((str(d), len((t or "").encode()), n := len(lib.encode(t or "", add_special_tokens=False).ids), n > 512) for d, t in rows)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(make(spark, rows)).collect())
    assert got == want


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("aé's'll 1²½ \n\t\r_-<|>.,İǅ\x1c\xa0日é"), max_size=60))
def test_pretokens_join_to_the_text_and_count_alone(t):
    lib = Tokenizer.from_file(default_vocabulary())
    freq, special = _pretokens(t, lib, ["<|endoftext|>"])
    n = special + sum(len(lib.encode(k, add_special_tokens=False).ids) * v for k, v in freq.items())
    assert n == len(lib.encode(t, add_special_tokens=False).ids)


def test_a_word_in_every_document_and_empty_tables(spark):
    docs = make(spark, [(i, f"common x{i}") for i in range(2000)])
    got = token_counts(docs.repartition(3)).collect()
    lib = Tokenizer.from_file(default_vocabulary())
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(lib.encode(f"common x{i}").ids) for i in range(2000)}
    assert token_counts(empty(spark)).count() == 0
