"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import tokenframe as tf
from tokenframe.functions import decode_col, encode_col
from tokenframe.sources.model import DEFINITIONS_SCHEMA
from tokenframe.sources.storage import new_folder, written_once

from .inputs import (
    ADDRESS,
    ADDRESS_SIDE,
    ADDRESSEE,
    ARTICLE_PHRASE,
    DEFINITIONS,
    addresses,
    model,
    table,
    texts,
)

MODES = ("whole", "start", "end", "any")
Query = Callable[[SparkSession, str], DataFrame]


def joined(array: str | Column) -> Column:
    return F.array_join(array, "|")


def tokenize_docs(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    found = tf.tokenize(docs, "text", model(spark))
    return found.select(
        "doc_id",
        F.col("text.raw_value").alias("raw_value"),
        joined("text.tokens").alias("tokens"),
        joined("text.types").alias("types"),
        joined("text.classes").alias("classes"),
    )


def tokenize_ids(spark, sf_dir):
    turns = texts(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    found = tf.tokenize(
        turns,
        "text",
        model(spark),
        raw_value=False,
        types=False,
        classes=False,
        type_ids=True,
        class_ids=True,
    )
    return found.select(
        "conv_id",
        "turn",
        joined("text.tokens").alias("tokens"),
        joined(F.col("text.type_ids").cast("array<string>")).alias("type_ids"),
        joined(F.col("text.class_ids").cast("array<string>")).alias("class_ids"),
    )


def decode_ids(spark, sf_dir):
    m = model(spark)
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat_ws(" ", "p_brand", "p_name", "p_type", "p_size").alias("label")
    )
    found = tf.tokenize(parts, "label", m, raw_value=False, types=False)
    ids = found.select(
        "p_partkey",
        F.col("label.tokens").alias("tokens"),
        encode_col(F.col("label.classes"), m.class_values).alias("ids"),
    )
    decoded = decode_col(F.col("ids"), F.col("tokens"), m.class_values)
    return ids.select("p_partkey", joined(decoded).alias("classes"))


def type_codes(spark, sf_dir):
    """Token types of code-like columns."""
    columns = [
        ("customer", "c_custkey", "c_name"),
        ("nation", "n_nationkey", "n_name"),
        ("orders", "o_orderkey", "o_orderpriority"),
        ("pages", "page_id", "url"),
        ("part", "p_partkey", "p_brand"),
        ("events", "event_id", "props"),
    ]
    values = None
    for name, key, column in columns:
        part = table(spark, sf_dir, name).select(
            F.lit(column).alias("source"),
            F.col(key).cast("bigint").alias("key"),
            F.col(column).alias("value"),
        )
        values = part if values is None else values.unionAll(part)
    found = tf.tokenize(values, "value", model(spark), classes=False, type_ids=True)
    return found.select(
        "source",
        "key",
        joined("value.types").alias("types"),
        joined(F.col("value.type_ids").cast("array<string>")).alias("type_ids"),
    )


def tokens_long(spark, sf_dir):
    turns = texts(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    long = tf.tokens_long(turns, ["conv_id", "turn"], "text", model(spark))
    return long.withColumn("pos", F.col("pos").cast("bigint"))


def _turn_tokens(spark, sf_dir):
    turns = texts(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    found = tf.tokenize(turns, "text", model(spark), raw_value=False, types=False, classes=False)
    return found.select("conv_id", "turn", F.col("text.tokens").alias("tokens"))


def dictionary_table(spark, sf_dir):
    """Ids must be dense, whatever value got which."""
    dictionary, _ = tf.dictionary_encode(_turn_tokens(spark, sf_dir), "tokens")
    return dictionary.agg(
        F.count("*").alias("n_values"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.count_distinct("id").alias("n_ids"),
    )


def dictionary_ordered(spark, sf_dir):
    """Every token of the documents with its id: ids ascend with the tokens."""
    docs = texts(spark, sf_dir, "documents", "text")
    tokens = tf.tokenize(docs, "text", model(spark), raw_value=False, types=False, classes=False)
    return tf.dictionary_ordered(tokens.select(F.explode_outer("text.tokens").alias("value")))


def dictionary_ids(spark, sf_dir):
    _, encoded = tf.dictionary_encode(_turn_tokens(spark, sf_dir), "tokens")
    return encoded.select("conv_id", "turn", joined(F.col("tokens").cast("array<string>")).alias("ids"))


def dictionary_roundtrip(spark, sf_dir):
    dictionary, encoded = tf.dictionary_encode(_turn_tokens(spark, sf_dir), "tokens")
    decoded = tf.dictionary_decode(written_once(encoded, "encoded"), "tokens", dictionary)
    return decoded.select("conv_id", "turn", joined("tokens").alias("tokens"))


def dictionary_roundtrip_literal(spark, sf_dir):
    """A dictionary of few values, in the plan on both ways: the words of part names and types."""
    words = F.split(F.concat_ws(" ", "p_name", "p_type", "p_brand"), " ")
    parts = table(spark, sf_dir, "part").select("p_partkey", words.alias("words"))
    dictionary, encoded = tf.dictionary_encode(parts, "words", lookup="literal")
    decoded = tf.dictionary_decode(encoded, "words", dictionary, out="back", lookup="literal")
    return decoded.select(
        "p_partkey",
        joined(F.col("words").cast("array<string>")).alias("ids"),
        joined("back").alias("words"),
    )


def _benchmark_words(spark, sf_dir):
    """A word list as long as the benchmark table makes it."""
    words = F.explode_outer(F.split("text", r"[^A-Za-z]+"))
    items = table(spark, sf_dir, "benchmark")
    entries = items.select(F.lit("BENCH_WORD").alias("class"), words.alias("entry")).distinct()
    return entries.where(F.length("entry") > 0)


def _benchmark_model(spark, sf_dir, lookup="join", prefilter=True):
    definitions = spark.createDataFrame(
        [(i, name, regex) for i, (name, regex) in enumerate(DEFINITIONS)], DEFINITIONS_SCHEMA
    )
    words = _benchmark_words(spark, sf_dir)
    return tf.Model.from_tables(
        definitions, words, max_inline_entries=10, lookup=lookup, prefilter=prefilter
    )


def _tokenize_with_lists(**options) -> Query:
    def query(spark, sf_dir):
        docs = texts(spark, sf_dir, "documents", "doc_id", "text")
        m = _benchmark_model(spark, sf_dir, **options)
        found = tf.tokenize(docs, "text", m, raw_value=False, types=False)
        return found.select("doc_id", joined("text.classes").alias("classes"))

    return query


def extract_join_lookup(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    m = _benchmark_model(spark, sf_dir)
    found = tf.extract(docs, "text", m, "<<WORD::BENCH_WORD>> <<NEXT@>>", "any")
    return found.select("doc_id", "text.*")


def class_coverage_join_lookup(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    return tf.class_coverage(docs, "text", _benchmark_model(spark, sf_dir))


def _extract(mode: str) -> Query:
    def query(spark, sf_dir):
        found = tf.extract(addresses(spark, sf_dir), "address", model(spark), ADDRESS, mode)
        return found.select("l_orderkey", "l_linenumber", "address.*")

    return query


def _extract_tokenized(fields: dict[str, bool], mode: str) -> Query:
    def query(spark, sf_dir):
        m = model(spark)
        tokenized = tf.tokenize(addresses(spark, sf_dir), "address", m, **fields)
        found = tf.extract(tokenized, "address", m, ADDRESS, mode)
        return found.select("l_orderkey", "l_linenumber", "address.*")

    return query


def extract_normalised(spark, sf_dir):
    """Tokens in lower case since tokenizing; the complement is cut from the text as it was."""
    m = model(spark)
    tokenized = tf.tokenize(addresses(spark, sf_dir), "address", m)
    lower = F.transform("address.tokens", F.lower)
    tokenized = tokenized.withColumn("address", F.col("address").withField("tokens", lower))
    found = tf.extract(tokenized, "address", m, ADDRESS, "any")
    return found.select("l_orderkey", "l_linenumber", "address.*")


def unknown_topk_large(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id", "source", "text")
    return tf.unknown_tokens(docs, "text", model(spark), 2_000, by="source", level="class")


def extract_documents(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    found = tf.extract(docs, "text", model(spark), ARTICLE_PHRASE, "any")
    return found.select("doc_id", "text.*")


def extract_first(spark, sf_dir):
    rules = [
        ("side", ADDRESS_SIDE),
        ("address", ADDRESS),
        ("addressee", ADDRESSEE, "start"),
    ]
    found = tf.extract_first(addresses(spark, sf_dir), "address", model(spark), rules)
    return found.select("l_orderkey", "l_linenumber", "address.*")


def class_profile(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id", "lang", "text")
    return tf.class_profile(docs, "text", model(spark), by="lang")


def class_profile_join_lookup(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id", "lang", "text")
    return tf.class_profile(docs, "text", _benchmark_model(spark, sf_dir), by="lang")


def type_profile(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id", "source", "text")
    return tf.class_profile(docs, "text", model(spark), by="source", kind="type")


def shape_topk(spark, sf_dir):
    return tf.shape_profile(addresses(spark, sf_dir), "address", model(spark), 10)


def shape_topk_turns(spark, sf_dir):
    turns = texts(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    return tf.shape_profile(turns, "text", model(spark), 20)


def shape_topk_join_lookup(spark, sf_dir):
    turns = texts(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    return tf.shape_profile(turns, "text", _benchmark_model(spark, sf_dir), 20)


def unknown_topk(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    return tf.unknown_tokens(docs, "text", model(spark), 50, key="doc_id")


def unknown_topk_threshold(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    return tf.unknown_tokens(docs, "text", model(spark), 100, key="doc_id", level="class", prune=True)


def unknown_topk_threshold_by_source(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id", "source", "text")
    return tf.unknown_tokens(docs, "text", model(spark), 10, by="source", prune=True)


def unknown_topk_by_source(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id", "source", "text")
    return tf.unknown_tokens(
        docs, "text", model(spark), 5, key="doc_id", by="source", level="class"
    )


def extraction_report(spark, sf_dir):
    patterns = [("address", ADDRESS), ("side", ADDRESS_SIDE), ("addressee", ADDRESSEE)]
    return tf.extraction_report(
        addresses(spark, sf_dir), "address", model(spark), patterns, MODES
    )


def class_coverage(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    return tf.class_coverage(docs, "text", model(spark))


def _phrase_model(spark, sf_dir):
    """Part names, of two words each, and their words: in capitals, as addresses have them."""
    name = F.upper("p_name")
    part = table(spark, sf_dir, "part")
    entries = part.select(F.lit("PART_NAME").alias("class"), name.alias("entry")).unionAll(
        part.select(F.lit("PART_WORD"), F.explode(F.split(name, " ")))
    )
    definitions = spark.createDataFrame(
        [(i, name, regex) for i, (name, regex) in enumerate(DEFINITIONS)], DEFINITIONS_SCHEMA
    )
    return tf.Model.from_tables(definitions, entries.distinct(), lookup="join")


def class_coverage_phrases(spark, sf_dir):
    found = addresses(spark, sf_dir)
    return tf.class_coverage(found, "address", _phrase_model(spark, sf_dir), phrases=True)


def class_coverage_addresses(spark, sf_dir):
    return tf.class_coverage(addresses(spark, sf_dir), "address", model(spark))


def check_tokenized(spark, sf_dir):
    m = model(spark)
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    return tf.check_tokenized(
        tf.tokenize(docs, "text", m, type_ids=True, class_ids=True), "text", m
    )


def check_tokenized_broken(spark, sf_dir):
    """Six of ten documents have one fault each in their tokenized struct."""
    m = model(spark)
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    found = tf.tokenize(docs, "text", m, type_ids=True, class_ids=True)
    s, case = F.col("text"), F.col("doc_id") % 10
    without_last = F.slice(s["classes"], F.lit(1), F.greatest(F.size(s["classes"]) - 1, F.lit(0)))
    unknown_ids = F.transform(s["type_ids"], lambda _: F.lit(254).cast("smallint"))
    nothing = F.lit(None).cast("string")
    first_null = F.transform(s["classes"], lambda c, i: F.when(i == 0, nothing).otherwise(c))
    faults = {
        1: ("raw_value", F.concat(s["raw_value"], F.lit("x"))),
        2: ("classes", without_last),
        3: ("types", F.lit(None).cast("array<string>")),
        4: ("type_ids", unknown_ids),
        5: ("tokens", F.concat(s["tokens"], F.array(F.lit("")))),
        6: ("classes", first_null),
    }
    fields = {name: s[name] for name in ("raw_value", "tokens", "types", "classes", "type_ids", "class_ids")}
    for number, (name, value) in faults.items():
        fields[name] = F.when(case == number, value).otherwise(fields[name])
    broken = found.select(F.struct(*[value.alias(name) for name, value in fields.items()]).alias("text"))
    return tf.check_tokenized(broken, "text", m)


def line_end_types(spark, sf_dir):
    """Codes with characters behind them that end a line for some regexes, though not for a model's."""
    ends = F.get(F.array(*map(F.lit, ("", "\u0085", "\u2028", "\u2029"))), (F.col("c_custkey") % 4).cast("int"))
    value = F.concat(
        F.lpad(F.col("c_custkey").cast("string"), 5, "0"),
        F.lit("-"),
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0"),
        ends,
        F.lit(" RTE"),
        F.when(F.col("c_custkey") % 3 == 0, "\u00857").otherwise("7"),
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", value.alias("v"))
    found = tf.tokenize(customers, "v", model(spark), classes=False)
    return found.select("c_custkey", joined("v.types").alias("types"))


def _lists_from_tables(spark, sf_dir):
    """Word lists taken from the tables; a part's colour word is also a part word."""
    words = F.split("p_name", " ")
    part = table(spark, sf_dir, "part")
    lists = [
        table(spark, sf_dir, "nation").select(F.lit("NATION").alias("class"), F.col("n_name")),
        table(spark, sf_dir, "region").select(F.lit("REGION"), "r_name"),
        table(spark, sf_dir, "customer").select(F.lit("SEGMENT"), "c_mktsegment"),
        table(spark, sf_dir, "orders").select(F.lit("PRIORITY"), "o_orderpriority"),
        part.select(F.lit("BRAND"), "p_brand"),
        part.select(F.lit("COLOUR"), F.get(words, F.lit(0))),
        part.select(F.lit("PART_WORD"), F.explode(words)),
    ]
    entries = lists[0]
    for more in lists[1:]:
        entries = entries.unionAll(more)
    return entries.toDF("class", "entry").distinct()


def _definitions_from_tables(spark, sf_dir):
    """A definition per event type, after the first of the model's own."""
    kinds = table(spark, sf_dir, "events").select(F.upper("event_type").alias("name")).distinct()
    own = spark.createDataFrame(
        [(i, name, regex) for i, (name, regex) in enumerate(DEFINITIONS)], DEFINITIONS_SCHEMA
    )
    return own.unionByName(
        kinds.select(
            F.lit(100).alias("ord"), "name", F.concat(F.lit("^"), F.col("name")).alias("regex")
        )
    )


def model_tables(spark, sf_dir):
    """Word lists from the tables, written as model files and read back."""
    folder = new_folder(spark, "model")
    _write_model(folder, _definitions_from_tables(spark, sf_dir), _lists_from_tables(spark, sf_dir))
    read = tf.read_definitions(spark, f"{folder}/TOKENDEFINITION").select(
        F.lit("definition").alias("kind"), F.col("name"), F.col("regex").alias("value")
    )
    return read.unionAll(
        tf.read_classes(spark, f"{folder}/TOKENCLASS").select(F.lit("class"), "class", "entry")
    )


def _write_model(folder: str, definitions: DataFrame, entries: DataFrame) -> None:
    """A model folder: a file for each word list, and one for the definitions, in order."""
    headers = entries.select("class").distinct()
    lines = headers.select(
        "class", F.lit(0).alias("rank"), F.concat(F.lit("TOKEN_CLASS: "), "class").alias("value")
    ).unionAll(entries.select("class", F.lit(1), "entry"))
    lines.repartition("class").sortWithinPartitions("class", "rank").select(
        "class", "value"
    ).write.partitionBy("class").text(f"{folder}/TOKENCLASS")
    lines = F.concat(
        F.lit("<NAME>"), "name", F.lit("</NAME>\t<VALUE>"), "regex", F.lit("</VALUE>\tnote")
    )
    definitions.orderBy("ord", "name").coalesce(1).select(lines).write.text(f"{folder}/TOKENDEFINITION")


def model_folder(spark, sf_dir):
    """A model written to a folder, loaded from there, and used: tokens and fields of customer lines."""
    folder = new_folder(spark, "model")
    customers, nations = (table(spark, sf_dir, name) for name in ("customer", "nation"))
    entries = nations.select(F.lit("NATION").alias("class"), F.col("n_name").alias("entry")).unionAll(
        customers.select(F.lit("SEGMENT"), "c_mktsegment")
    )
    _write_model(folder, _definitions_from_tables(spark, sf_dir), entries.distinct())
    m = tf.Model.load(spark, folder)
    line = F.concat_ws(
        " ",
        F.col("c_custkey") % 100,
        F.upper(F.left("c_mktsegment", F.lit(3))),
        "c_mktsegment",
        "n_name",
        F.when(F.col("c_custkey") % 5 == 0, "odd"),
    )
    lines = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", line.alias("line")
    )
    tokenized = tf.tokenize(lines, "line", m)
    pattern = "<<KEY#>> <<WORD@+>> <<SEG::SEGMENT>> <<NATION::NATION>>"
    found = tf.extract(tokenized, "line", m, pattern, out="fields")
    return found.select("c_custkey", joined("line.classes").alias("classes"), "fields.*")


def vocabulary(spark, sf_dir):
    return tf.vocabulary(_definitions_from_tables(spark, sf_dir), _lists_from_tables(spark, sf_dir))


def validate_model(spark, sf_dir):
    return tf.validate_model(
        _definitions_from_tables(spark, sf_dir), _lists_from_tables(spark, sf_dir)
    )


def validate_model_problems(spark, sf_dir):
    """Every problem there is, made of the tables."""
    own = _definitions_from_tables(spark, sf_dir)
    again = own.where("ord = 100").withColumn("regex", F.lit("again"))
    nameless = table(spark, sf_dir, "region").select(F.lit(200).alias("ord"), F.lit("").alias("name"), F.col("r_name").alias("regex"))
    bare = table(spark, sf_dir, "nation").select(
        F.lit(300).alias("ord"), F.col("n_name").alias("name"), F.lit(None).cast("string").alias("regex")
    )
    customers = table(spark, sf_dir, "customer")
    entries = _lists_from_tables(spark, sf_dir)
    entries = entries.unionAll(customers.select(F.lit(""), "c_mktsegment"))
    entries = entries.unionAll(table(spark, sf_dir, "region").select(F.lit("NATION"), F.lit("")))
    entries = entries.unionAll(customers.select("c_name", F.concat("c_name", F.lit("!"))))
    return tf.validate_model(own.unionByName(again).unionByName(nameless).unionByName(bare), entries)


def _turn_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "conversations").schema
    # As a pattern the path may be one file as well as a folder of files; as a plain path only the latter.
    files = spark.readStream.schema(schema).parquet(f"{sf_dir}/conversations.parque[t]")
    return files.select("conv_id", "turn", "text")


def _run(stream: DataFrame, name: str) -> DataFrame:
    spark = stream.sparkSession
    folder = new_folder(spark, name)
    query = tf.write_stream(
        stream, f"{folder}/rows", f"{folder}/checkpoint", available_now=True
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def stream_tokenize(spark, sf_dir):
    found = tf.tokenize(_turn_stream(spark, sf_dir), "text", model(spark), raw_value=False)
    return _run(
        found.select(
            "conv_id",
            "turn",
            joined("text.tokens").alias("tokens"),
            joined("text.types").alias("types"),
            joined("text.classes").alias("classes"),
        ),
        "tokens",
    )


def stream_extract(spark, sf_dir):
    turns = _turn_stream(spark, sf_dir)
    found = tf.extract(turns, "text", model(spark), ARTICLE_PHRASE, "any")
    return _run(found.select("conv_id", "turn", "text.*"), "fields")


def stream_tokenize_join(spark, sf_dir):
    """Word lists looked up by join in every micro-batch."""
    m = _benchmark_model(spark, sf_dir)
    folder = new_folder(spark, "batches")

    def classes(batch):
        found = tf.tokenize(batch, "text", m, raw_value=False, types=False)
        return found.select("conv_id", "turn", joined("text.classes").alias("classes"))

    stream = _turn_stream(spark, sf_dir)
    tf.write_batches(stream, classes, f"{folder}/rows", f"{folder}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(f"{folder}/rows").drop("batch_id")


QUERIES: dict[str, Query] = {
    "tokenize_docs": tokenize_docs,
    "tokenize_ids": tokenize_ids,
    "decode_ids": decode_ids,
    "type_codes": type_codes,
    "tokens_long": tokens_long,
    "dictionary_table": dictionary_table,
    "dictionary_ordered": dictionary_ordered,
    "dictionary_ids": dictionary_ids,
    "dictionary_roundtrip": dictionary_roundtrip,
    "dictionary_roundtrip_literal": dictionary_roundtrip_literal,
    "tokenize_table_lookup": _tokenize_with_lists(lookup="inline"),
    "tokenize_join_lookup": _tokenize_with_lists(prefilter=False),
    "tokenize_join_filtered": _tokenize_with_lists(),
    **{f"extract_{mode}": _extract(mode) for mode in MODES},
    "extract_from_struct": _extract_tokenized({}, "any"),
    "extract_from_ids": _extract_tokenized(
        {"raw_value": False, "types": False, "classes": False, "class_ids": True}, "start"
    ),
    "extract_no_raw": _extract_tokenized({"raw_value": False, "types": False}, "whole"),
    "extract_normalised": extract_normalised,
    "extract_documents": extract_documents,
    "extract_join_lookup": extract_join_lookup,
    "extract_first": extract_first,
    "class_profile": class_profile,
    "class_profile_join_lookup": class_profile_join_lookup,
    "type_profile": type_profile,
    "shape_topk": shape_topk,
    "shape_topk_turns": shape_topk_turns,
    "shape_topk_join_lookup": shape_topk_join_lookup,
    "unknown_topk": unknown_topk,
    "unknown_topk_threshold": unknown_topk_threshold,
    "unknown_topk_threshold_by_source": unknown_topk_threshold_by_source,
    "unknown_topk_by_source": unknown_topk_by_source,
    "unknown_topk_large": unknown_topk_large,
    "extraction_report": extraction_report,
    "class_coverage": class_coverage,
    "class_coverage_addresses": class_coverage_addresses,
    "class_coverage_phrases": class_coverage_phrases,
    "class_coverage_join_lookup": class_coverage_join_lookup,
    "check_tokenized": check_tokenized,
    "check_tokenized_broken": check_tokenized_broken,
    "line_end_types": line_end_types,
    "model_folder": model_folder,
    "model_tables": model_tables,
    "vocabulary": vocabulary,
    "validate_model": validate_model,
    "validate_model_problems": validate_model_problems,
    "stream_tokenize": stream_tokenize,
    "stream_extract": stream_extract,
    "stream_tokenize_join": stream_tokenize_join,
}
