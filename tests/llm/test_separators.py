import numpy as np
import pytest
from tokenizers import Tokenizer

from srcweave.llm import separators
from srcweave.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001/documents.parquet"


def brute(ids, end):
    out, start = [], 0
    for i, x in enumerate(ids):
        if x == end:
            out.append((start, i - start, True))
            start = i + 1
    return out + ([(start, len(ids) - start, False)] if start < len(ids) else [])


@pytest.mark.parametrize("width", [2, 4])
def test_blocks_of_any_size(spark, tmp_path, width):
    rng = np.random.default_rng(3)
    files = {
        "a": rng.integers(0, 4, 500),
        "b": np.array([], int),
        "c": np.array([3]),
        "d": np.array([1, 2]),
        "e": np.array([3, 3, 3, 1]),
        "f": np.repeat(1, 64),
        "g": np.array([1] * 63 + [3]),
    }
    for name, ids in files.items():
        (tmp_path / f"{name}.bin").write_bytes(ids.astype(f"<u{width}").tobytes())
    expected = {n: brute(ids.tolist(), 3) for n, ids in files.items() if len(ids)}
    for block in (1, 2, 7, 64, 1000):
        found: dict[str, list] = {}
        for r in separators.count_tokens(spark, str(tmp_path), 3, width, block).orderBy("file", "doc_no").collect():
            rows = found.setdefault(r.file.rsplit("/", 1)[1][0], [])
            assert r.doc_no == len(rows)
            rows.append((r.start, r.n_tokens, r.closed))
        assert found == expected


def test_half_an_id_is_an_error(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="no whole ids"):
        separators.count_tokens(spark, str(tmp_path), 3).collect()


def test_against_the_library(spark, tmp_path):
    docs = spark.read.parquet(SF).select("text", "doc_id")
    odd = spark.createDataFrame([(None, 1), ("", 2), ("a <|endoftext|> b\nc", 3), ("w " * 70_000, 4), ("w", 4), ("w", 4)], docs.schema)
    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    both = docs.unionByName(odd)
    path = str(tmp_path / "flat")
    separators.write_flat_tokens(both, path, tokenizer_path(), 49407)
    counts = sorted(r.n_tokens for r in separators.count_tokens(spark, path, 49407, block_tokens=5000).collect())
    assert counts == sorted(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in both.collect())


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "flat")
    separators.write_flat_tokens(spark.createDataFrame([], "text string"), path, tokenizer_path(), 49407)
    assert separators.count_tokens(spark, path, 49407).count() == 0
