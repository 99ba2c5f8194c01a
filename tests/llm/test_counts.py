import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as registry
from keepsight.llm.token_counts import PreTokens, count_tokens, piece_counts
from tests.llm.conftest import ODD

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(VOCABULARY)


def library_count(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def counted(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def expected(rows, limit=512):
    out = []
    for doc_id, text, *_ in rows:
        n = library_count(text)
        out.append((doc_id, len((text or "").encode()), n, n > limit))
    return sorted(out, key=str)


CUTTER = PreTokens(VOCABULARY)
#: Letters, marks, white space, contractions, added tokens, characters of several editions.
PARTS = ["a", " ", "  ", "\n", "\t", "'s", "'", "’ll", "12", "٣", "é", "́", "\u0085", " ", "　",
         "<|endoftext|>", "<|endof", "|>", "ß", "中文", "🙂", "\U0003fc3d", "՘", "\U00011de0", "Ⅷ", ".", "—", "\x00"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.characters(exclude_categories=["Cs"])), max_size=30))
def test_pre_tokens_sum_to_the_librarys_count(parts):
    text = "".join(parts)
    found, tokens = CUTTER.frequencies(text)
    pieces = dict(zip(found, CUTTER.pieces(list(found)), strict=True))
    assert tokens + sum(pieces[t] * n for t, n in found.items()) == library_count(text)


@pytest.mark.parametrize("common", [{32: 100_000, 4_096: 1_000}, {4: 2, 20: 1}, {}])
def test_counts_equal_the_library(spark, documents, common):
    rows = [
        *ODD,
        (8, "lone \U0003fc3d words " * 40, "en", "s"),
        (9, "=" * 6000 + " tail", "en", "s"),
        (10, "=" * 6000 + " tail", None, None),
        (11, "  <|endoftext|>  <|endoftext|>x", None, None),
    ]
    assert counted(count_tokens(documents(rows), VOCABULARY, common=common)) == expected(rows)


def test_each_pre_token_is_counted_once(spark, documents):
    rows = [(1, "to be or not to be", None, None), (2, "to be", None, None), (3, None, None, None)]
    found = {r[0]: (r[1], r[2]) for r in piece_counts(documents(rows), VOCABULARY).collect()}
    assert found == {"to": (1, 2), " be": (1, 2), " or": (1, 1), " not": (1, 1), " to": (1, 1)}


def test_no_documents(spark, documents):
    assert counted(count_tokens(documents([]), VOCABULARY)) == []


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        PreTokens(public_tokenizers.path("word_bpe_49k.json"))


def test_query_equals_the_library(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    df = registry.queries()["op11_token_counts"](spark, folder)
    assert df.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    assert counted(df) == expected(rows)
