from public_tokenizers import path
from tokenizers import Tokenizer

from tidemark.llm.token_counts import token_counts

TOKENIZER = path("byte_bpe_50k.json")


def test_counts_of_edge_documents(edge_docs):
    library = Tokenizer.from_file(TOKENIZER)
    expected = sorted((str(r["doc_id"]), len((r["text"] or "").encode()), len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in edge_docs.collect())
    got = token_counts(edge_docs, TOKENIZER, limit=8).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == expected
    assert all(r["over_limit"] == (r["n_tokens"] > 8) for r in got)


def test_empty_table(no_docs):
    assert token_counts(no_docs, TOKENIZER).count() == 0
