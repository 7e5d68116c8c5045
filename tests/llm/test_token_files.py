import struct
import zlib

import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from ordermill.llm.token_files import read_documents, with_crc32, write_token_files
from ordermill.llm.tokens import vocabulary
from tests.conftest import plan_of


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


def test_round_trip(spark, odd_docs, library, tmp_path):
    path = str(tmp_path / "t")
    more = odd_docs.limit(0).unionAll(odd_docs)
    write_token_files(more, path, vocabulary(), 2, row_group_bytes=1 << 16, page_rows=2)
    found = with_crc32(read_documents(spark, path, "tokens")).collect()
    every = sorted(odd_docs.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, wanted = 0, []
    for doc_id, text in every:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        wanted.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == wanted


def test_files_have_page_indexes_and_read_by_column(spark, odd_docs, tmp_path):
    path = str(tmp_path / "t")
    write_token_files(odd_docs, path, vocabulary(), 2, page_rows=2)
    encodings = {}
    for file in tmp_path.glob("t/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                column = meta.row_group(g).column(c)
                assert column.has_offset_index and column.has_column_index
                encodings.setdefault(column.path_in_schema, set()).update(column.encodings)
    tokens = next(k for k in encodings if k.startswith("tokens"))
    assert "RLE_DICTIONARY" in encodings[tokens]
    assert "DELTA_BINARY_PACKED" in encodings["doc_id"]
    plan = plan_of(read_documents(spark, path, "n_tokens"))
    assert "tokens:array" not in plan


def test_empty_table(spark, no_docs, tmp_path):
    write_token_files(no_docs, str(tmp_path / "t"), vocabulary(), 2)
    assert with_crc32(read_documents(spark, str(tmp_path / "t"), "tokens")).count() == 0


def test_an_id_with_a_third_of_the_rows_is_cut(spark, tmp_path):
    """Different texts, equal ones, and rows without an id; no help from adaptive execution."""
    rows = [(k, f"text {k}") for k in range(2_000)] + [(7, f"other {k}") for k in range(1_000)]
    rows += [(7, "the same")] * 1_000 + [(None, f"none {k % 3}") for k in range(1_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        path = str(tmp_path / "t")
        write_token_files(docs, path, vocabulary(), 2)
        sizes = sorted(r["count"] for r in spark.read.parquet(path).groupBy("part").count().collect())
        assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]
        found = read_documents(spark, path, "n_tokens").orderBy("start").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    ids = [-1 if r.doc_id is None else r.doc_id for r in found]
    assert ids == sorted(ids) and len(ids) == len(rows)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(found, found[1:]))
