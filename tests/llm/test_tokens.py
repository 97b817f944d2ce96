import random

import numpy as np
import pyarrow as pa
import pytest

from leadspark.llm import textscan as ts
from leadspark.llm import tokens

KINDS = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]
ODD = [
    "",
    None,
    " ",
    "  two  spaces   three \n\n x \n y\n  z",
    "tabs\tand\r\nlines\x0b\x0cx\n\n\ny",
    "it's we're don't I'll 'quoted' l'été s'il",
    "no break em 　wide\u0085nel  line x  y",
    "été, naïve. Straße! ×÷± ét á. ≠ ½ ² Ⅷ ١٢",
    "a <|endoftext|> b <|startoftext|>c <| |>",
    "<|endoftext|>",
    "ABC.DEF,ghi;jkl a.b.c 3.14 x1y2 $%& «quoted» “x” …",
    "中文字 日本語 한국어 😀 x😀y . ' ''",
    "\x00null\x1f unit",
    "ΟΔΥΣΣΕΥΣ İstanbul ǅ ŉ",
    "end ",
    "word.\nNext",
]


@pytest.mark.parametrize("name,spaced", KINDS)
def test_ids_equal_those_of_whole_texts(name, spaced, sf):
    import duckdb

    enc = tokens.Encoder(tokens.vocabulary(name), spaced)
    rng = random.Random(4)
    alphabet = list("ab. ,'\n\t-é ß<|>3É") + ["  ", "<|endoftext|>", "the", " ", "́"]
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(1500)]
    texts += [r[0] for r in duckdb.sql(f"SELECT text FROM '{sf}/documents.parquet'").fetchall()]
    for size in (1 << 20, 300):
        for p in ts.slices(pa.array(texts, pa.string()), size):
            ids, count = enc.encode(p)
            ends = np.cumsum(count)
            for i, t in enumerate(texts[p.lo : p.hi]):
                assert ids[ends[i] - count[i] : ends[i]].tolist() == enc.whole(t or ""), repr(t)


def test_table_of_chunks_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_CHUNKS", 5)
    enc = tokens.Encoder(tokens.vocabulary("byte_bpe_50k.json"), True)
    for k in range(20):
        text = " ".join(f"word{k + j}" for j in range(9))
        ids, count = enc.encode(next(ts.slices(pa.array([text]))))
        assert ids.tolist() == enc.whole(text) and count.tolist() == [len(ids)]


def test_end_ids():
    ids, count = tokens.with_end(np.array([5, 6, 7], np.uint16), np.array([2, 0, 1]))
    assert ids.tolist() == [5, 6, 0, 0, 7, 0] and count.tolist() == [3, 1, 2]
