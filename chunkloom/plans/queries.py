"""Every operator as a query over the shared tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.functions import properties as props
from chunkloom.functions.distance import pick_vector
from chunkloom.functions.ids import uuid_column
from chunkloom.functions.text import hashed_term_vector
from chunkloom.operators import levels, mutate
from chunkloom.operators.ingest import explode_documents
from chunkloom.operators.predicates import compile_filter
from chunkloom.operators.regroup import documents_json
from chunkloom.operators.requests import with_defaults
from chunkloom.operators.storage import scratch_path, spread
from chunkloom.plans import search
from chunkloom.plans.answer import answer
from chunkloom.sources import catalog, corpus
from chunkloom.sources.catalog import scan_collection, scan_tenant
from chunkloom.sources.fetch import fetch_stored
from chunkloom.streaming.ingest import ingest, stream_documents

Query = Callable[[SparkSession, str], DataFrame]

TENANTS = ("tenant_0", "tenant_1", "tenant_2")

# The filters of the predicate queries.
FILTERS: dict[str, dict] = {
    "filter_eq": {"having_all": {"document_metadata.language": "en"}},
    "filter_ne": {"having_all": {"document_metadata.language !=": "en"}},
    "filter_lt": {"having_all": {"custom_properties.label <": 4}},
    "filter_le": {"having_all": {"custom_property.label <=": 4}},
    "filter_gt": {"having_all": {"custom_properties.label >": 4}},
    "filter_ge": {"having_all": {"custom_properties.label >=": 4}},
    "filter_contains": {"having_all": {"custom_properties.tags contains": ["10", "12"]}},
    "filter_in": {"having_all": {"custom_properties.label in": [1, 3, 5]}},
    "filter_not_in": {"having_all": {"custom_properties.label not-in": [1, 3, 5]}},
    "filter_like": {"having_all": {"document_metadata.source ~": "s*c1*"}},
    "filter_all": {
        "having_all": {"document_metadata.language": "en", "custom_properties.label >=": 5}
    },
    "filter_any": {
        "having_any": {"document_metadata.language": "fr", "custom_properties.quality": 1}
    },
    "filter_all_any": {
        "having_all": {"hierarchy_level >=": 1, "document_metadata.language !=": "de"},
        "having_any": {"custom_properties.quality": 0, "custom_properties.label in": [2, 7]},
    },
}


def _filter_query(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        chunks = corpus.chunks(spark, folder)
        kept = chunks.where(compile_filter(chunks.schema, **FILTERS[name]))
        return kept.select("chunk_id", "filename", "hierarchy_level")

    return run


def _view(spark: SparkSession, folder: str) -> str:
    corpus.chunks(spark, folder).createOrReplaceTempView("chunk_collection")
    return "chunk_collection"


def _plain(chunks: DataFrame) -> DataFrame:
    return chunks.select(
        "chunk_id", "filename", "hierarchy_level", "parent_id", "original_span_end",
        F.col("document_metadata.language").alias("language"),
        F.col("custom_properties.label").alias("label"), "tenant",
    )


def scan_collection_query(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(scan_collection(spark, None, default=_view(spark, folder)))


def scan_tenant_query(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(scan_tenant(spark, _view(spark, folder), "tenant_1"))


def ingest_explode(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(explode_documents(corpus.documents(spark, folder)))


def chunk_properties(spark: SparkSession, folder: str) -> DataFrame:
    rows = explode_documents(corpus.documents(spark, folder), "text_vector")
    return rows.select(
        "chunk_id", "filename", F.md5(F.col("content").cast("binary")).alias("content_md5"),
        "original_span_start", "original_span_end", "hierarchy_level",
        F.col("document_metadata.source").alias("source"),
        F.col("custom_properties.quality").alias("quality"),
        F.size(F.try_element_at("embeddings", F.lit("text_vector"))).alias("vector_size"),
    )


def request_defaults(spark: SparkSession, folder: str) -> DataFrame:
    label = F.col("label")
    requests = corpus.vector_requests(spark, folder).select(
        "request_id", "query_embedding",
        F.when(label < 3, "dot").when(label < 5, "").alias("method"),
        F.when(label % 2 == 0, label).alias("top"),
        F.when(label == 9, "replace").alias("parent_strategy"),
    )
    defaults = {"top": "12", "horizon": 0.75, "method": "manhattan", "vector_name": "", "no_such": 1}
    return with_defaults(requests, defaults).select(
        "request_id", "method", "top", "horizon", "vector_name", "parent_strategy", "include_vector",
        F.size("query_embedding").alias("dimensions"),
    )


def _entries(chunks: DataFrame) -> Column:
    return F.concat(
        *[
            props.flatten_properties(F.col(c), chunks.schema[c].dataType, c)
            for c in ("document_metadata", "custom_properties")
        ]
    )


def flatten_properties(spark: SparkSession, folder: str) -> DataFrame:
    chunks = corpus.chunks(spark, folder)
    rows = chunks.select("chunk_id", F.explode(_entries(chunks)).alias("p"))
    return rows.select(
        "chunk_id", F.col("p.path").alias("path"), props.flat_name(F.col("p.path")).alias("flat_name"),
        F.col("p.value").cast("string").alias("value"),
    )


def flatten_variant(spark: SparkSession, folder: str) -> DataFrame:
    events = corpus.table(spark, folder, "events")
    nested = F.parse_json(
        F.concat(F.lit('{"kind":"'), "event_type", F.lit('","more":{"props":'), "props", F.lit("}}"))
    )
    rows = events.select("event_id", F.explode(props.flatten_variant(nested)).alias("p"))
    return rows.select(
        "event_id", F.col("p.path").alias("path"), F.col("p.value").cast("string").alias("value")
    )


def flatten_deep(spark: SparkSession, folder: str) -> DataFrame:
    """The properties of events below twelve levels of objects; the depth comes from the data."""
    rows = props.flattened(_deep_events(spark, folder, 12), "deep", "entries").select("event_id", F.explode("entries").alias("p"))
    return rows.select("event_id", F.col("p.path").alias("path"), F.col("p.value").cast("string").alias("value"))


def _deep_events(spark: SparkSession, folder: str, levels: int) -> DataFrame:
    opened = "".join(f'{{"a{i}":' for i in range(levels))
    text = F.concat(F.lit(opened), "props", F.lit("}" * levels))
    events = spread(corpus.table(spark, folder, "events").select("event_id", "props"))
    return events.select("event_id", F.parse_json(text).alias("deep"))


def unflatten_deep(spark: SparkSession, folder: str) -> DataFrame:
    """Properties below twenty levels, flattened to flat names and rebuilt by their paths."""
    entries = props.flattened(_deep_events(spark, folder, 20), "deep", "entries").withColumns(
        {"names": props.property_map(F.col("entries")), "flat": props.flat_properties(F.col("entries"))}
    )
    back = props.unmapped(entries.select("event_id", "names", "flat"), "flat", "names", "back")
    path = "$" + "".join(f".a{i}" for i in range(20))
    return back.select("event_id", F.variant_get("back", path + ".k", "bigint").alias("k"))


def unflatten_types(spark: SparkSession, folder: str) -> DataFrame:
    """Dates, times and numbers of events keep their types in a rebuilt object."""
    given = {"when.day": F.to_date("ts"), "when.time": F.col("ts"), "value": F.col("value"), "who": F.col("user_id")}
    entries = F.array(
        *[F.struct(F.lit(path).alias("path"), value.cast("variant").alias("value")) for path, value in given.items()]
    )
    events = corpus.table(spark, folder, "events").select("event_id", entries.alias("e"))
    back = events.select("event_id", props.unflatten_properties(F.col("e")).alias("v"))
    kind = lambda path: F.schema_of_variant(F.variant_get("v", path, "variant"))
    return back.select(
        "event_id",
        F.variant_get("v", "$.when.day", "date").alias("day"),
        F.variant_get("v", "$.value", "double").alias("value"),
        F.variant_get("v", "$.who", "bigint").alias("who"),
        kind("$.when.day").alias("day_kind"),
        kind("$.value").alias("value_kind"),
    )


def filter_variant_bigint(spark: SparkSession, folder: str) -> DataFrame:
    """Integers that differ only beyond the digits of a double."""
    number = (F.lit(2**53) + F.col("event_id") % 5).cast("string")
    events = corpus.table(spark, folder, "events").select(
        "event_id", F.parse_json(F.concat(F.lit('{"k":'), number, F.lit("}"))).alias("custom_properties")
    )
    keep = compile_filter(events.schema, {"custom_properties.k >": 2**53, "custom_properties.k in": [2**53, 2**53 + 1]})
    return events.where(keep).select("event_id")


def filter_none(spark: SparkSession, folder: str) -> DataFrame:
    chunks = corpus.chunks(spark, folder)
    keep = compile_filter(chunks.schema)
    return (chunks if keep is None else chunks.where(keep)).select("chunk_id", "filename", "hierarchy_level")


def uuid_normalise(spark: SparkSession, folder: str) -> DataFrame:
    """Ids written in four ways, made from a digest of each text."""
    digest = F.md5(F.col("text").cast("binary"))
    written = (
        F.when(F.col("doc_id") % 4 == 0, F.upper(digest))
        .when(F.col("doc_id") % 4 == 1, F.concat(F.lit("{"), digest, F.lit("}")))
        .when(F.col("doc_id") % 4 == 2, F.concat(F.lit("urn:uuid:"), digest))
        .otherwise(F.regexp_replace(digest, "^(.{8})(.{4})", "$1-$2-"))
    )
    return corpus.table(spark, folder, "documents").select("doc_id", uuid_column(written).alias("uuid"))


def native_distance(spark: SparkSession, folder: str) -> DataFrame:
    """One request, the first embedding, as a plan of built-in expressions."""
    query = corpus.vector_requests(spark, folder).where("request_id = '0'").first()["query_embedding"]
    found = search.search_one(corpus.chunks(spark, folder), query, "l2-squared", top=50)
    return found.select("chunk_id", F.round("distance", 6).alias("distance"))


def flat_name(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.table(spark, folder, "documents").select(
        "doc_id",
        props.flat_name(F.concat(F.lit("document_metadata."), "source")).alias("flat_name"),
        props.flat_name_of_parts(F.array("lang", "source")).alias("parts_name"),
    )


def _read_back(nested: DataFrame) -> DataFrame:
    def get(path: str, kind: str) -> Column:
        return F.try_variant_get("nested", f"$.{path}", kind)

    return nested.select(
        "chunk_id",
        get("document_metadata.language", "string").alias("language"),
        get("document_metadata.source", "string").alias("source"),
        get("custom_properties.label", "int").alias("label"),
        get("custom_properties.quality", "int").alias("quality"),
        F.array_join(get("custom_properties.tags", "array<string>"), "|").alias("tags"),
    )


def unflatten_properties(spark: SparkSession, folder: str) -> DataFrame:
    chunks = corpus.chunks(spark, folder)
    return _read_back(
        chunks.select("chunk_id", props.unflatten_properties(_entries(chunks)).alias("nested"))
    )


def unmap_properties(spark: SparkSession, folder: str) -> DataFrame:
    chunks = corpus.chunks(spark, folder)
    flat = chunks.select("chunk_id", _entries(chunks).alias("entries")).select(
        "chunk_id",
        props.flat_properties(F.col("entries")).alias("flat"),
        F.map_filter(
            props.property_map(F.col("entries")), lambda _, path: path != "custom_properties.quality"
        ).alias("names"),
    )
    return _read_back(
        flat.select("chunk_id", props.unmap_properties(F.col("flat"), F.col("names")).alias("nested"))
    )


def filter_variant(spark: SparkSession, folder: str) -> DataFrame:
    events = corpus.table(spark, folder, "events").select(
        "event_id", F.parse_json("props").alias("custom_properties")
    )
    keep = compile_filter(
        events.schema,
        {"custom_property.k >=": 40, "custom_property.k not-in": [50, 60]},
        {"custom_property.k <": 70, "custom_property.k contains": [90, "91"], "custom_property.x": 1},
    )
    return events.where(keep).select("event_id")


def named_vector(spark: SparkSession, folder: str) -> DataFrame:
    name = F.when(F.col("hierarchy_level") == 0, "low_space").when(F.col("hierarchy_level") == 1, "")
    chunks = corpus.chunks(spark, folder).withColumn("vector", pick_vector(F.col("embeddings"), name))
    total = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x)
    return chunks.where(F.col("vector").isNotNull()).select(
        "chunk_id", F.size("vector").alias("dimensions"), F.round(total, 6).alias("total")
    )


def _level(level: int) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        chunks = corpus.chunks(spark, folder)
        return chunks.where(levels.at_level(chunks, level)).select("chunk_id", "hierarchy_level")

    return run


def max_level(spark: SparkSession, folder: str) -> DataFrame:
    return levels.max_level(corpus.chunks(spark, folder))


def chunks_per_level(spark: SparkSession, folder: str) -> DataFrame:
    return levels.chunks_per_level(corpus.chunks(spark, folder))


def _hits(rows: DataFrame) -> DataFrame:
    return rows.select("request_id", "chunk_id", F.round("distance", 6).alias("distance"), "rank")


def _knn(**params: Callable[[], Column]) -> Query:
    """All embeddings as requests against all chunks, with parameters per request."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        requests = corpus.vector_requests(spark, folder).withColumns(
            {name: make() for name, make in params.items()}
        )
        return _hits(search.vector_search(corpus.chunks(spark, folder), requests, by_file=False, fields=()))

    return run


def _signs_query(spark: SparkSession, folder: str) -> DataFrame:
    signs = F.transform("query_embedding", lambda x: F.when(x > 0, 1.0).otherwise(0.0).cast("float"))
    requests = corpus.vector_requests(spark, folder).withColumn("query_embedding", signs)
    defaults = {"method": "hamming", "vector_name": "signs", "top": 10}
    return _hits(
        search.vector_search(corpus.chunks(spark, folder), requests, defaults, by_file=False)
    )


def include_vector(spark: SparkSession, folder: str) -> DataFrame:
    requests = corpus.vector_requests(spark, folder).withColumn(
        "include_vector", F.col("label") % 2 == 0
    )
    rows = search.vector_search(corpus.chunks(spark, folder), requests, {"top": 3}, by_file=False)
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x)
    return rows.select("request_id", "chunk_id", "rank", F.round(total, 6).alias("vector_total"))


def _documents(found: DataFrame) -> DataFrame:
    """Result documents with their chunk ids as text, to compare them as plain values."""
    return found.select(
        "request_id", "filename", "first_place",
        F.col("document_metadata.language").alias("language"),
        F.array_join(F.transform("chunks", lambda c: c["chunk_id"]), ",").alias("chunk_ids"),
    )


def _filtered_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Requests with four different filters, two of them in a tenant or at a level."""
    label = F.col("label")
    return corpus.vector_requests(spark, folder).withColumns(
        {
            "having_all": F.when(label < 3, '{"document_metadata.language": "en"}').when(
                label < 6, '{"custom_properties.label >=": 2, "document_metadata.source ~": "src1*"}'
            ),
            "having_any": F.when(
                label >= 8, '{"document_metadata.language": "fr", "custom_properties.quality": 1}'
            ),
            "tenant_name": F.when(label < 6, None).when(label < 8, "tenant_2"),
            "operation_level": F.when(label >= 8, -1),
            "top": F.lit(10),
        }
    )


def vector_search(spark: SparkSession, folder: str) -> DataFrame:
    chunks = corpus.chunks(spark, folder)
    return _documents(search.vector_search(chunks, _filtered_requests(spark, folder)))


def group_by_file(spark: SparkSession, folder: str) -> DataFrame:
    requests = corpus.vector_requests(spark, folder)
    return _documents(search.vector_search(corpus.chunks(spark, folder), requests, {"top": 40}))


def result_json(spark: SparkSession, folder: str) -> DataFrame:
    """Result documents as JSON text, read back to compare them as values."""
    requests = corpus.vector_requests(spark, folder)
    defaults = {"top": 5, "include_vector": True}
    found = search.vector_search(corpus.chunks(spark, folder), requests, defaults)
    read = F.from_json(
        "document",
        "filename string, document_metadata struct<language:string, source:string>, "
        "chunks array<struct<chunk_id:string, original_span:array<bigint>, embedding:array<float>>>",
    )
    parsed = documents_json(found).select("request_id", "first_place", read.alias("d"))
    values = F.flatten(F.transform("d.chunks", lambda c: c["embedding"]))
    return parsed.select(
        "request_id", "first_place", "d.filename", F.col("d.document_metadata.source").alias("source"),
        F.array_join(F.transform("d.chunks", lambda c: c["chunk_id"]), ",").alias("chunk_ids"),
        F.aggregate(
            F.transform("d.chunks", lambda c: c["original_span"][1]), F.lit(0).cast("bigint"), lambda a, x: a + x
        ).alias("span_ends"),
        F.round(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), 5).alias("vector_total"),
    )


def _parents(strategy: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        requests = corpus.vector_requests(spark, folder)
        rows = search.vector_search(
            corpus.chunks(spark, folder), requests, {"top": 10, "parent_strategy": strategy}, by_file=False
        )
        return rows.select("request_id", "chunk_id", "place", "is_parent", "hierarchy_level")

    return run


def text_search(spark: SparkSession, folder: str) -> DataFrame:
    """Texts of the benchmark against embeddings made of the chunks' whole contents."""
    vectors = F.create_map(F.lit("default"), hashed_term_vector(F.col("content")))
    chunks = corpus.chunks(spark, folder).withColumn("embeddings", vectors)
    requests = corpus.text_requests(spark, folder)
    return _hits(search.text_search(chunks, requests, {"top": 10}, by_file=False))


def bm25(spark: SparkSession, folder: str) -> DataFrame:
    requests = corpus.text_requests(spark, folder)
    found = search.keyword_search(corpus.chunks(spark, folder), requests, {"top": 10})
    return found.select("request_id", "chunk_id", F.round("score", 6).alias("score"), "rank")


def text_search_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks without vectors, embedded as they are stored and as they are replaced; then searched."""
    name, _ = _scratch(spark)
    without_vector = F.transform("chunks", lambda c: c.withField("embedding", F.lit(None).cast("array<float>")))
    for tenant in TENANTS:
        catalog.create_tenant(spark, name, tenant)
        mine = corpus.documents(spark, folder, tenant).drop("tenant").withColumn("chunks", without_vector)
        catalog.persist_documents(spark, name, mine, tenant, embed=hashed_term_vector)
        revised = corpus.upsert_batch(spark, folder, tenant).drop("tenant")
        catalog.persist_chunks(spark, name, revised, tenant, embed=hashed_term_vector)
    requests = corpus.text_requests(spark, folder)
    chunks, fetch = scan_collection(spark, name), fetch_stored(spark, name)
    return _hits(search.text_search(chunks, requests, {"top": 10}, by_file=False, fetch=fetch))


def hybrid_search(spark: SparkSession, folder: str) -> DataFrame:
    """Each benchmark text together with the embedding of the same number."""
    vectors = corpus.vector_requests(spark, folder).select("request_id", "query_embedding")
    alpha = F.when(F.col("request_id").cast("int") % 2 == 0, 0.3)
    requests = corpus.text_requests(spark, folder).join(vectors, "request_id", "left").withColumn("alpha", alpha)
    found = search.hybrid_search(corpus.chunks(spark, folder), requests, {"top": 10}, by_file=False)
    return found.select("request_id", "chunk_id", F.round("score", 6).alias("score"), "rank")


def _stored(rows: DataFrame) -> DataFrame:
    return rows.select(
        "chunk_id", "tenant", "filename", "hierarchy_level",
        F.md5(F.col("content").cast("binary")).alias("content_md5"),
        F.col("embeddings").isNotNull().alias("has_vectors"),
    )


def upsert_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = mutate.upsert(corpus.chunks(spark, folder), corpus.upsert_batch(spark, folder))
    return _stored(rows)


def upsert_counts(spark: SparkSession, folder: str) -> DataFrame:
    _, counts = mutate.upsert(corpus.chunks(spark, folder), corpus.upsert_batch(spark, folder))
    return counts


def upsert_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return _stored(mutate.last_of_each(corpus.upsert_batch(spark, folder)))


def _label_one(spark: SparkSession, folder: str) -> DataFrame:
    wanted = corpus.table(spark, folder, "embeddings").where(F.col("label") == 1)
    return wanted.select(F.col("vec_id").cast("string").alias("chunk_id"))


def delete_by_id(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = mutate.delete_by_ids(corpus.chunks(spark, folder), _label_one(spark, folder))
    return _stored(rows)


def delete_counts(spark: SparkSession, folder: str) -> DataFrame:
    _, counts = mutate.delete_by_ids(corpus.chunks(spark, folder), _label_one(spark, folder))
    return counts


def delete_by_filename(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = mutate.delete_by_filename(corpus.chunks(spark, folder), "doc_3.txt")
    return _stored(rows)


def delete_document(spark: SparkSession, folder: str) -> DataFrame:
    french = corpus.documents(spark, folder).where(F.col("document_metadata.language") == "fr")
    rows, _ = mutate.delete_document(corpus.chunks(spark, folder), french)
    return _stored(rows)


def delete_by_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = mutate.delete_by_filter(
        corpus.chunks(spark, folder),
        having_any={"document_metadata.language": "fr", "custom_properties.quality": 0},
    )
    return _stored(rows)


METADATA_TYPE = "STRUCT<language: STRING, source: STRING>"
CUSTOM_TYPE = "STRUCT<label: INT, quality: INT, tags: ARRAY<STRING>>"


def _scratch(spark: SparkSession, tenancy: bool = True, text_index: bool = False) -> tuple[str, str]:
    """A new collection for one query, with its files in the shared folder."""
    name = f"scratch_{uuid.uuid4().hex}"
    folder = scratch_path(spark, name)
    catalog.create_collection(
        spark, name, metadata_type=METADATA_TYPE, custom_type=CUSTOM_TYPE,
        multi_tenancy={"enabled": tenancy}, buckets=4, location=f"{folder}/table",
        text_index=text_index,
    )
    return name, folder


def _filled(spark: SparkSession, folder: str, text_index: bool = False) -> str:
    """All documents persisted, each tenant's into its own tenant."""
    name, _ = _scratch(spark, text_index=text_index)
    for tenant in TENANTS:
        catalog.create_tenant(spark, name, tenant)
        mine = corpus.documents(spark, folder, tenant).drop("tenant")
        catalog.persist_documents(spark, name, mine, tenant)
    return name


def persist_committed(spark: SparkSession, folder: str) -> DataFrame:
    """Documents persisted, then a batch of new versions and new chunks committed on top."""
    name = _filled(spark, folder)
    for tenant in TENANTS:
        mine = corpus.upsert_batch(spark, folder, tenant).drop("tenant")
        catalog.persist_chunks(spark, name, mine, tenant)
    return _stored(scan_collection(spark, name))


def delete_committed(spark: SparkSession, folder: str) -> DataFrame:
    """Deletes by filter over all tenants, by file in one tenant, and of a whole tenant."""
    name = _filled(spark, folder)
    catalog.delete_matching(
        spark, name, having_any={"document_metadata.language": "fr", "custom_properties.quality": 0}
    )
    catalog.delete_file(spark, name, "doc_3.txt", "tenant_0")
    catalog.drop_tenant(spark, name, "tenant_2")
    return _stored(scan_collection(spark, name))


def delete_emptied(spark: SparkSession, folder: str) -> DataFrame:
    """A tenant emptied by a filter, one dropped, made again and filled with one file."""
    name = _filled(spark, folder)
    catalog.delete_matching(spark, name, {"hierarchy_level >=": 0}, tenant="tenant_0")
    catalog.drop_tenant(spark, name, "tenant_1")
    catalog.create_tenant(spark, name, "tenant_1")
    one = corpus.documents(spark, folder).where("filename = 'doc_1.txt'").drop("tenant")
    catalog.persist_documents(spark, name, one, "tenant_1")
    return _stored(scan_collection(spark, name))


def describe_collection(spark: SparkSession, folder: str) -> DataFrame:
    """The properties of a filled collection with the number of chunks it holds."""
    name = _filled(spark, folder)
    count = scan_collection(spark, name).agg(F.count("*").alias("nr_chunks"))
    about = catalog.describe_collection(spark, name).where("property IN ('chunk_id', 'content', 'hierarchy_level')")
    return about.select("multi_tenancy", "property", "type").join(F.broadcast(count))


def drop_collection(spark: SparkSession, folder: str) -> DataFrame:
    """A filled collection dropped and made again in the same place with the documents of one tenant."""
    name, place = _scratch(spark)
    for tenants in (TENANTS, TENANTS[2:]):
        if tenants != TENANTS:
            catalog.drop_collection(spark, name)
            catalog.create_collection(
                spark, name, metadata_type=METADATA_TYPE, custom_type=CUSTOM_TYPE, buckets=4, location=f"{place}/table"
            )
        for tenant in tenants:
            catalog.create_tenant(spark, name, tenant)
            mine = corpus.documents(spark, folder, tenant).drop("tenant")
            catalog.persist_documents(spark, name, mine, tenant)
    return _stored(scan_collection(spark, name))


def search_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Requests that name their collection and tenant, answered as JSON from stored tables."""
    name = _filled(spark, folder)
    requests = corpus.vector_requests(spark, folder).withColumns(
        {"collection_name": F.lit(name), "tenant_name": F.concat(F.lit("tenant_"), (F.col("label") % 3).cast("string"))}
    )
    read = F.from_json("document", "filename string, chunks array<struct<chunk_id:string>>")
    found = answer(spark, requests, {"top": 5}).select("request_id", "first_place", read.alias("d"))
    ids = F.array_join(F.col("d.chunks.chunk_id"), ",")
    return found.select("request_id", "first_place", "d.filename", ids.alias("chunk_ids"))


def bm25_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Keyword search on stored postings, after an upsert of new versions and a delete by filter.

    Every other request searches one tenant, by that tenant's statistics.
    """
    name = _filled(spark, folder, text_index=True)
    for tenant in TENANTS:
        catalog.persist_chunks(spark, name, corpus.upsert_batch(spark, folder, tenant).drop("tenant"), tenant)
    catalog.delete_matching(spark, name, {"document_metadata.language": "fr"})
    number = F.col("request_id").cast("int")
    own = F.when(number % 2 == 1, F.concat(F.lit("tenant_"), (number % 3).cast("string")))
    requests = corpus.text_requests(spark, folder).withColumn("tenant_name", own)
    found = search.stored_keyword_search(spark, name, requests, {"top": 10})
    return found.select("request_id", "tenant", "chunk_id", F.round("score", 6).alias("score"), "rank")


def knn_tiles(spark: SparkSession, folder: str) -> DataFrame:
    """The way of batches too large to broadcast: request blocks meet chunk blocks in a join."""
    requests = corpus.vector_requests(spark, folder)
    chunks = corpus.chunks(spark, folder)
    return _hits(search.vector_search(chunks, requests, {"top": 10}, by_file=False, in_tiles=True))


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as JSON messages, streamed into a collection without tenants."""
    name, place = _scratch(spark, tenancy=False)
    corpus.documents(spark, folder).drop("tenant").write.json(f"{place}/feed")
    feed = stream_documents(spark, f"{place}/feed", METADATA_TYPE, CUSTOM_TYPE)
    ingest(feed, name, f"{place}/progress").awaitTermination()
    return _stored(scan_collection(spark, name))


def commit_replayed(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches of a stream for each tenant, and both played again after the second.

    The first batch played again would bring old versions back; it is known and changes nothing.
    """
    name, _ = _scratch(spark)
    for tenant in TENANTS:
        catalog.create_tenant(spark, name, tenant)
        documents, batch = (made(spark, folder, tenant).drop("tenant") for made in (corpus.documents, corpus.upsert_batch))
        for number in (0, 1, 0, 1):
            stream = (f"feed-of-{tenant}", number)
            if number == 0:
                catalog.persist_documents(spark, name, documents, tenant, stream=stream)
            else:
                catalog.persist_chunks(spark, name, batch, tenant, stream=stream)
    return _stored(scan_collection(spark, name))


QUERIES: dict[str, Query] = {
    "bm25_stored": bm25_stored,
    "commit_replayed": commit_replayed,
    "delete_emptied": delete_emptied,
    "describe_collection": describe_collection,
    "drop_collection": drop_collection,
    "filter_none": filter_none,
    "filter_variant_bigint": filter_variant_bigint,
    "flatten_deep": flatten_deep,
    "knn_tiles": knn_tiles,
    "native_distance": native_distance,
    "search_stored": search_stored,
    "unflatten_deep": unflatten_deep,
    "unflatten_types": unflatten_types,
    "uuid_normalise": uuid_normalise,
    "vector_search": vector_search,
    "scan_collection": scan_collection_query,
    "scan_tenant": scan_tenant_query,
    "ingest_explode": ingest_explode,
    "request_defaults": request_defaults,
    "result_json": result_json,
    "chunk_properties": chunk_properties,
    "flatten_properties": flatten_properties,
    "flatten_variant": flatten_variant,
    "flat_name": flat_name,
    "unflatten_properties": unflatten_properties,
    "unmap_properties": unmap_properties,
    "filter_variant": filter_variant,
    "named_vector": named_vector,
    "include_vector": include_vector,
    **{name: _filter_query(name) for name in FILTERS},
    "level_abs": _level(1),
    "level_from_bottom": _level(-2),
    "max_level": max_level,
    "chunks_per_level": chunks_per_level,
    "knn_cosine": _knn(top=lambda: F.lit(10)),
    "knn_dot": _knn(top=lambda: F.lit(10), method=lambda: F.lit("dot")),
    "knn_l2": _knn(top=lambda: F.lit(10), method=lambda: F.lit("l2-squared")),
    "knn_manhattan": _knn(top=lambda: F.lit(10), method=lambda: F.lit("manhattan")),
    "knn_hamming": _signs_query,
    "knn_topk": _knn(top=lambda: F.col("label") + 1),
    "knn_horizon": _knn(horizon=lambda: 0.5 + F.col("label") / 20),
    "knn_autocut": _knn(top=lambda: F.lit(50), auto_limit=lambda: F.col("label") % 3 + 1),
    "knn_autocut_unlimited": _knn(auto_limit=lambda: F.col("label") % 3 + 1),
    "group_by_file": group_by_file,
    "parent_replace": _parents("replace"),
    "parent_include": _parents("include"),
    "text_search": text_search,
    "text_search_stored": text_search_stored,
    "bm25": bm25,
    "hybrid_search": hybrid_search,
    "upsert_rows": upsert_rows,
    "upsert_counts": upsert_counts,
    "upsert_dedup": upsert_dedup,
    "delete_by_id": delete_by_id,
    "delete_counts": delete_counts,
    "delete_by_filename": delete_by_filename,
    "delete_document": delete_document,
    "delete_by_filter": delete_by_filter,
    "persist_committed": persist_committed,
    "delete_committed": delete_committed,
    "stream_ingest": stream_ingest,
}
