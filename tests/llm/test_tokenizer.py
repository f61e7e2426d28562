import base64

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from spanloom.llm import tokenizer

HARD = ["", " ", "  ", "a  b", "a   b", " a", "a ", "a\n b", "a\n \nb", " 's it's WE'VE", "\x1c \x1d a\x1f", "　 x", "\xa0 x", "\x00\x01 ​", "\x00", "<|endoftext|>", "é" * 300, "a" * 20_000, "ab" * 3000, "日本語のテキスト", "👩‍🔬🧪", "½²③ 12٣", "don't\r\n\tstop"]


@pytest.fixture(scope="module")
def reference():
    with open(tokenizer.vocabulary_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=tokenizer.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(texts):
    own = tokenizer.encoder(tokenizer.vocabulary_path())
    ids, counts = own.encode(texts)
    assert own.count(texts).tolist() == counts.tolist()
    out, at = [], 0
    for n in counts.tolist():
        out.append(ids[at : at + n].tolist())
        at += n
    return out


def test_hard_texts(reference):
    assert ids_of(HARD) == [reference.encode_ordinary(t) for t in HARD]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab  \n\t'sé日0½\x00.!　Ж")), min_size=1, max_size=6))
def test_any_texts(reference, texts):
    assert ids_of(texts) == [reference.encode_ordinary(t) for t in texts]


def test_perfect_hash_is_minimal():
    keys = [str(i).encode() for i in range(5000)]
    hashes = tokenizer.key_hashes(keys)
    assert sorted(tokenizer.PerfectHash.of(hashes).slots(hashes).tolist()) == list(range(5000))


def test_frames(spark, reference):
    df = spark.createDataFrame([(1, t, 0) for t in HARD] + [(2, None, 1), (None, "x", 1)], "doc_id long, text string, ids int")
    got = tokenizer.token_ids(df).collect()
    assert len(got) == len(HARD) + 2
    assert [r["ids"] for r in got if r["doc_id"] == 2] == [[]] and [r["ids"] for r in got if r["doc_id"] is None] == [reference.encode_ordinary("x")]
    counts = tokenizer.token_counts(df, ["doc_id"]).collect()
    assert sorted(r["tokens"] for r in counts) == sorted(len(r["ids"]) for r in got)
    assert tokenizer.token_ids(df.limit(0)).count() == 0
