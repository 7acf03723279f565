import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from strata.llm import byte_bpe as bb

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return bb.Vocabulary(bb.read_ranks(PATH))


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def texts():
    rng = random.Random(1)
    pools = ["ab c'srtveldm \n\t", "    '’", "éüñ日本語한국어", "0123٣½²", "!?.,-_=*#<>|`~", "\x00\x1c\x1f\x85​﻿", "🙂👩‍👧", "aA'S"]
    out = []
    for _ in range(2500):
        p = "".join(rng.sample(pools, rng.randint(1, len(pools))))
        out.append("".join(rng.choice(p) for _ in range(rng.randint(0, 40))))
    for _ in range(1500):
        out.append("".join(chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(30)))
    return out + ["a" * 5000, " " * 3000, "\n" * 100 + "x", "'", "''s", " 's", "x's's", "don't we'll they'RE", "<|endoftext|>"]


def test_perfect_hash_is_minimal(vocabulary):
    assert sorted(vocabulary.hash.slot_of.tolist()) == list(range(len(vocabulary.ranks)))


def test_ids_equal_the_library_and_decode_back(vocabulary, library):
    given = texts()
    ids, n = vocabulary.encode([t.encode() for t in given])
    at = 0
    for t, k in zip(given, n.tolist()):
        assert ids[at:at + k].tolist() == library.encode_ordinary(t)
        at += k
    assert vocabulary.decode(ids)[0] == "".join(given).encode()


def test_query(spark, write_table, edge_docs, no_docs, library):
    out = bb.op5_byte_level_bpe(spark, write_table(documents=edge_docs)).collect()
    given = edge_docs.select("doc_id", "text").collect()

    def row(d, t):
        ids = library.encode_ordinary(t or "")
        return (str(d), len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(),
                hashlib.sha256((t or "").encode()).hexdigest())
    assert sorted((str(r[0]), *r[1:]) for r in out) == sorted(row(*r) for r in given)
    assert bb.op5_byte_level_bpe(spark, write_table(documents=no_docs)).count() == 0


def test_columns_are_kept(spark, edge_docs):
    shared = bb.broadcast_vocabulary(spark, PATH)
    out = bb.decode(bb.encode(edge_docs, shared), shared)
    assert out.columns == [c for c in edge_docs.columns if c != "text"] + ["n_tokens", "ids", "decoded"]
    assert out.count() == edge_docs.count()
