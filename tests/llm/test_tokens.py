"""Token files and token counts against the tokenizer library on whole texts."""
from __future__ import annotations

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import tokencounts as C
from ledgerline.llm import tokenfile as F
from ledgerline.llm.queries import tokenizer_file
from ledgerline.llm.tables import scratch
from tests.llm.fixtures import clashing, documents, odd_texts, prose

PATH = tokenizer_file("word_bpe_49k.json")
HARD = ["a<|endoftext|>b <|startoftext|>", "it's we'll I'd  don't", "café café ́x", "ΑΣ ΑΣ. Σ", "x y z\x1fq\x85w",
        "日本語 テキスト 12345 ½", "\U0001f600‍\U0001f525 e️", "İstanbul ǅ ﬁ", "a" * 5000, " lead trail ", "\r\n\t\x0b\x0c",
        "no̸ ̸ ≠", "'s 't '", "가 ᅡᄀ", "<|endoftext|", "100% #tag @me"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def texts():
    return odd_texts() + [(100 + i, t) for i, t in enumerate(HARD)] + [(200 + i, prose(i, 300, 90)) for i in range(50)]


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts(spark, texts, library):
    got = C.count_tokens(clashing(documents(spark, texts)), PATH, most=50)
    want = []
    for d, t in texts:
        n = len(ids(library, t))
        want.append((d, len((t or "").encode()), n, n > 2048))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    assert C.count_tokens(documents(spark, texts).limit(0), PATH).count() == 0


def test_counts_do_not_depend_on_the_table(spark, texts):
    d = documents(spark, texts)
    assert sorted(map(str, C.count_tokens(d, PATH, most=1).collect())) == sorted(map(str, C.count_tokens(d, PATH).collect()))


def test_file_round_trip(spark, texts, library):
    unique = [(d, t) for d, t in texts if d is not None and d != 5] + [(5, "five")]
    path = scratch(spark, "tokens")
    F.write_tokens(clashing(documents(spark, unique)), path, PATH)
    tokens = F.read_tokens(spark, path)
    rows = {r["doc_id"]: r["ids"] for r in tokens.collect()}
    assert rows == {d: [*ids(library, t), 1] for d, t in unique}
    got = {r["doc_id"]: r for r in F.token_index(tokens).collect()}
    start = 0
    for d, t in sorted(unique):
        own = [*ids(library, t), 1]
        crc = zlib.crc32(np.array(own, dtype="<u4").tobytes())
        assert tuple(got[d]) == (d, start, len(own), crc)
        start += len(own)


def test_repeated_and_null_ids_agree_between_runs(spark, texts):
    runs = []
    for n in (2, 5):
        path = scratch(spark, "tokens")
        F.write_tokens(documents(spark, texts).repartition(n), path, PATH)
        runs.append(sorted(map(str, F.token_index(F.read_tokens(spark, path)).collect())))
    assert runs[0] == runs[1] and len(runs[0]) == len(texts)


def test_metadata_prunes(spark, texts):
    path = scratch(spark, "tokens")
    F.write_tokens(documents(spark, texts), path, PATH)
    one = F.read_tokens(spark, path).where("doc_id = 210")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,210)]" in one._jdf.queryExecution().toString()
    assert one.count() == 1
    from pyarrow import orc
    from pathlib import Path
    files = [orc.ORCFile(str(f)) for f in Path(path.removeprefix("file:")).glob("*.orc")]
    assert files and all(f.compression == "ZSTD" for f in files)


def test_empty_table(spark, texts):
    path = scratch(spark, "tokens")
    F.write_tokens(documents(spark, texts).limit(0), path, PATH)
    assert F.token_index(F.read_tokens(spark, path)).count() == 0
