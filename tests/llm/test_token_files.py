import io
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from scorelake.llm import token_files
from scorelake.llm.common import shared_folder


def folder(spark):
    return f"{shared_folder(spark)}/ids-{uuid.uuid4().hex}"


def plain_ids(texts, name="word_bpe_49k.json", end_id=2):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, end_id] for t in texts]


def numbers(raw):
    return np.frombuffer(raw, "<u4").tolist()


@pytest.fixture(scope="module")
def written(spark, docs):
    place = folder(spark)
    files = token_files.write_ids(docs, place, file_bytes=20_000)
    return place, files


def test_round_trip_equals_the_tokenizer(spark, docs, written):
    place, files = written
    rows = docs.select("doc_id", "text").collect()
    got = sorted(token_files.read_ids(spark, place).collect(), key=lambda r: r.start)
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    want = sorted(((r.doc_id, ids) for r, ids in zip(rows, plain_ids([r.text for r in rows]), strict=True)), key=key)
    assert sorted(((r.doc_id, numbers(r.ids)) for r in got), key=key) == want
    assert [r.doc_id for r in got] == [x[0] for x in want]
    sizes = [len(r.ids) // 4 for r in got]
    assert [r.start for r in got] == [sum(sizes[:k]) for k in range(len(sizes))]
    told = files.orderBy("shard").collect()
    assert len(told) > 3 and sum(r.documents for r in told) == len(rows) and sum(r.tokens for r in told) == sum(sizes)
    assert [r.base for r in told] == [sum(x.tokens for x in told[:k]) for k in range(len(told))]


def test_look_up_gives_the_wanted_documents_alone(spark, docs, written):
    place, _ = written
    wanted = spark.createDataFrame([(3,), (0,), (3,), (None,), (10**9,), (-5,), (57,)], "doc_id long")
    all_rows = token_files.read_ids(spark, place)
    want = all_rows.filter("doc_id IN (3, 0, 57)").collect()
    assert sorted(map(str, token_files.look_up(spark, place, wanted).collect())) == sorted(map(str, want))
    assert len(want) == 4  # document 0 is there twice
    assert token_files.look_up(spark, place, wanted.filter("false")).count() == 0


def test_other_tokenizers_and_tables(spark, docs, empty):
    import public_tokenizers

    place = folder(spark)
    texts = ["one two", None, "<|endoftext|> x", "é🙂"] * 2
    table = spark.createDataFrame([(f"k{i // 2}", t, 1) for i, t in enumerate(texts)], "doc_id string, text string, base int")
    token_files.write_ids(table, place, tokenizer=public_tokenizers.path("byte_bpe_50k.json"), end_id=70_000)
    got = sorted((r.doc_id, numbers(r.ids)) for r in token_files.read_ids(spark, place).collect())
    assert got == sorted((f"k{i // 2}", ids) for i, ids in enumerate(plain_ids(texts, "byte_bpe_50k.json", 70_000)))
    assert token_files.look_up(spark, place, spark.createDataFrame([("k1",)], "doc_id string")).count() == 2
    place = folder(spark)
    assert token_files.write_ids(empty, place).count() == 0
    assert token_files.read_ids(spark, place).count() == 0
    assert token_files.look_up(spark, place, docs).count() == 0


def test_one_id_on_many_rows_fills_many_files(spark):
    table = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("the same words again and again").alias("text"))
    place = folder(spark)
    files = token_files.write_ids(table, place, file_bytes=20_000).collect()
    assert sum(r.documents for r in files) == 3000 and max(r.documents for r in files) < 1200
    assert token_files.read_ids(spark, place).agg(F.countDistinct("start")).first()[0] == 3000
    assert token_files.look_up(spark, place, spark.range(5).withColumnRenamed("id", "doc_id")).count() == 0


def test_files_of_lost_tasks_are_passed_over_and_swept(spark, docs):
    from pathlib import Path

    place = folder(spark)
    token_files.write_ids(docs, place, file_bytes=50_000)
    before = token_files.read_ids(spark, place).count()
    stray = Path(place.removeprefix("file:"), "ids-000000-lost.zst")
    stray.write_bytes(b"half a file")
    assert token_files.read_ids(spark, place).count() == before
    assert token_files.sweep(spark, place) == 1 and not stray.exists()
    assert token_files.sweep(spark, place) == 0 and token_files.read_ids(spark, place).count() == before


class Counted(io.BytesIO):
    taken = 0

    def read(self, size=-1):
        out = super().read(size)
        self.taken += len(out)
        return out


def one_file(documents, width=2):
    out = io.BytesIO()
    writer = token_files.Writer(out, pa.int64(), width)
    for low in range(0, len(documents), 7):
        part = documents[low : low + 7]
        at = np.concatenate(([0], np.cumsum([len(d) for d in part])))
        writer.add(pa.array(range(low, low + len(part)), pa.int64()), np.concatenate([np.zeros(0, np.uint32), *part]).astype(np.uint32), at)
    writer.close()
    return out.getvalue()


def documents(n=400, most=3000):
    rng = np.random.default_rng(4)
    return [rng.integers(0, 40_000, rng.integers(0, most)) for _ in range(n)] + [rng.integers(0, 40_000, 200_000)]


def test_a_reader_takes_only_the_frames_it_needs():
    docs = documents()
    raw = one_file(docs)
    file = Counted(raw)
    reader = token_files.Reader(file)
    opened = file.taken
    assert len(reader.raw) > 5 and opened < len(raw) / 20
    for k in (0, 123, 399, 400):
        before = file.taken
        ((rows, ids),) = reader.read(np.array([k]))
        assert rows.tolist() == [k] and numbers(ids[0]) == docs[k].tolist()
        assert file.taken - before == reader.place[reader.frame_of[k] + 1] - reader.place[reader.frame_of[k]]
    assert [numbers(x) for _, ids in reader.read(np.arange(len(docs))) for x in ids] == [d.tolist() for d in docs]


def test_frames_are_plain_zstandard():
    docs = documents(50)
    raw = one_file(docs, 4)
    out = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert zlib.crc32(out) == zlib.crc32(np.concatenate(docs).astype("<u4").tobytes())


def test_damage_is_told():
    raw = bytearray(one_file(documents(50)))
    reader = token_files.Reader(io.BytesIO(raw))
    raw[int(reader.place[1]) - 6] ^= 1  # within the first frame
    damaged = token_files.Reader(io.BytesIO(raw))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        damaged.frame(0)
    assert np.array_equal(damaged.frame(1), reader.frame(1))
    with pytest.raises(ValueError):
        token_files.Reader(io.BytesIO(bytes(raw[:-1]) + b"x"))


def test_a_file_without_tokens():
    reader = token_files.Reader(io.BytesIO(one_file([])))
    assert len(reader.index) == 0 and list(reader.read(np.arange(0))) == []
