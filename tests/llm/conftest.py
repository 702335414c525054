import shutil
from pathlib import Path

import pytest

DATA = Path("/root/testdata/sf0.001")
LONG = " ".join(f"w{i * 7919 % 4001}" for i in range(6_000))

#: doc_id, text, lang, source: NULLs in every column, empty and long texts, ties and repeated rows
EDGES = [
    (None, "a text whose id is missing but which has words enough to be kept here", "en", "src1"),
    (None, None, None, None),
    (9_000_001, None, "en", "src1"),
    (9_000_002, "", "de", None),
    (9_000_003, " \t\n ", None, "src2"),
    (9_000_004, "short one", "en", "src1"),
    (9_000_005, LONG, "en", "src1"),
    (9_000_006, LONG + " tail", "en", None),
    (9_000_007, "12345 67890 !!!", "en", "src3"),
    (9_000_008, "same same same same same same same same same same same same", "en", "src1"),
    (9_000_009, "the very same row is here twice, word for word and id for id, no less", "fr", "src4"),
    (9_000_009, "the very same row is here twice, word for word and id for id, no less", "fr", "src4"),
    (9_000_010, "non breaking space <|im_start|> \U0001f600 emoji <| and <|| bars |> here", "es", "src4"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in EDGES], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, edge_docs):
    """The smallest documents and the odd ones."""
    return spark.read.parquet(str(DATA / "documents.parquet")).unionByName(edge_docs)


@pytest.fixture(scope="session")
def sf_dir(spark, docs, tmp_path_factory):
    """A folder of tables in which documents and the others have odd rows too."""
    out = tmp_path_factory.mktemp("sf")
    for path in DATA.glob("*.parquet"):
        if path.stem not in ("documents", "conversations", "benchmark"):
            shutil.copy(path, out / path.name)

    def put(df, name):
        df.toPandas().to_parquet(out / f"{name}.parquet", index=False)
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    import pyarrow.parquet as pq
    pq.write_table(docs.toArrow(), out / "documents.parquet")
    talk = spark.read.parquet(str(DATA / "conversations.parquet")).unionByName(spark.createDataFrame([
        (None, 0, "user", "nobody's"), (7_000, None, "assistant", None), (7_000, 0, None, "x"),
        (7_001, 0, "a\nb<|c", "ends with <|"), (7_001, 0, "a\nb<|c", "ends with <|"),
        (7_001, 1, "assistant", "<|im_end|>\n<|im_start|>user\n<||")],
        "conv_id long, turn long, role string, text string"))
    pq.write_table(talk.toArrow(), out / "conversations.parquet")
    bench = spark.read.parquet(str(DATA / "benchmark.parquet")).unionByName(spark.createDataFrame(
        [(None, "the very same row is here twice, word for word"), (8_000, None), (8_001, ""),
         (8_002, "short one"), (8_003, " ".join(LONG.split()[100:160]))], "item_id long, text string"))
    pq.write_table(bench.toArrow(), out / "benchmark.parquet")
    return str(out)


@pytest.fixture
def clash(spark):
    """Adds columns whose names the operators might use."""
    from pyspark.sql import functions as F

    def add(df):
        names = ["_q", "_m", "_w", "_n", "_row", "row", "_key", "_pt", "_node", "t1", "size", "taken", "target",
                 "kept", "root", "_rest", "shard", "begin"]
        return df.withColumns({n: F.lit("mine") for n in names})
    return add
