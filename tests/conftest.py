import os
import sys
import uuid

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__  # noqa: E402,F401  ships the package with the tasks

HARBOUR = uuid.UUID("6f1c2a9e-0d5b-4c57-9a41-2b7f3e8d1c60")
PARENT = str(uuid.uuid5(HARBOUR, "tide table"))
CHILD = str(uuid.uuid5(HARBOUR, "low water"))
PARENT_VECTOR = [0.5, 1.0, 0.0, -1.0, 0.25, 2.0]
CHILD_VECTOR = [1.5, 1.0, -0.5, -1.0, 0.75, 1.0]
DOCUMENTS = (
    "filename string, document_metadata string, chunks array<struct<chunk_id:string, "
    "content:string, original_span:array<bigint>, hierarchy_level:int, parent_id:string, "
    "custom_properties:string, embedding:array<float>>>"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("chunkloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def documents(spark):
    """One file with a section and a sentence of it."""
    section = (PARENT, "Tide table of the old harbour. Low water is at noon.", [100, 152], 0, None, "{}", PARENT_VECTOR)
    sentence = (CHILD, "Low water is at noon.", [131, 152], 1, PARENT, '{"gauge": {"name": "pier"}, "metres": 2}', CHILD_VECTOR)
    about = '{"language": "sv", "source": "almanac"}'
    return _open(spark.createDataFrame([("tides.md", about, [section, sentence])], DOCUMENTS))


@pytest.fixture
def other_documents(spark):
    """A second file of three chunks without embeddings."""
    chunks = [
        ("rope", "Three kinds of rope", [0, 19], 0, None, "{}", None),
        ("hemp", "Hemp swells when it is wet", [20, 46], 0, None, "{}", []),
        ("wire", "Wire does not", [47, 60], 0, None, "{}", None),
    ]
    return _open(spark.createDataFrame([("ropes.md", '{"language": "da", "source": "notes"}', chunks)], DOCUMENTS))


def _open(rows):
    """Metadata and custom properties as VARIANT."""
    opened = F.transform(
        "chunks", lambda c: c.withField("custom_properties", F.parse_json(c["custom_properties"]))
    )
    return rows.withColumn("document_metadata", F.parse_json("document_metadata")).withColumn(
        "chunks", opened
    )


@pytest.fixture
def simple_chunks(spark, documents):
    from chunkloom.operators.ingest import explode_documents

    coarse = F.slice("embeddings.default", 1, 2)
    return (
        explode_documents(documents)
        .withColumn("tenant", F.lit("__default__"))
        .withColumn("embeddings", F.map_concat("embeddings", F.create_map(F.lit("coarse"), coarse)))
        .drop("position")
    )
