"""The model as two tables, and the small snapshot of it that plans are built from."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.literal_table import LiteralTable
from ..functions.membership import BitmapFilter
from ..functions.tokens import COMMON_BLANKS, definition_type, element_hash
from .model_files import read_classes, read_definitions

DEFINITIONS_SCHEMA = "ord int, name string, regex string"
CLASSES_SCHEMA = "class string, entry string"
# Ids are single bytes, and two of them are taken: so many values fit a vocabulary.
MAX_VOCABULARY = 254
# Longer word lists become a literal table.
MAX_INLINE_ENTRIES = 2_000
LOOKUPS = ("inline", "join")


def vocabulary(definitions: DataFrame, classes: DataFrame) -> DataFrame:
    """``(kind, id, value)``: dense ids in byte order of the value.

    Kind ``type`` holds the definition names, kind ``class`` those and the class
    names. A valid model has at most 254 values in each.
    """
    names = definitions.select(F.col("name").alias("value")).distinct()
    class_names = classes.select(F.col("class").alias("value")).distinct()
    values = names.select(F.lit("type").alias("kind"), "value").union(
        names.union(class_names).distinct().select(F.lit("class").alias("kind"), "value")
    )
    by_value = Window.partitionBy("kind").orderBy("value")
    return values.select(
        "kind", (F.row_number().over(by_value) - 1).cast("smallint").alias("id"), "value"
    )


def validate_model(definitions: DataFrame, classes: DataFrame) -> DataFrame:
    """``(problem, detail)``: one row for each thing that makes the model unusable."""
    names = definitions.select("name", "regex")
    entries = classes.select("class", "entry").distinct()

    def problems(rows: DataFrame, problem: str, detail) -> DataFrame:
        return rows.select(F.lit(problem).alias("problem"), detail.cast("string").alias("detail"))

    def is_empty(column: str):
        return F.coalesce(F.trim(column), F.lit("")) == ""

    sizes = (
        names.select(F.lit("type").alias("kind"), F.col("name").alias("value"))
        .union(names.select(F.lit("class"), F.col("name")))
        .union(entries.select(F.lit("class"), F.col("class")))
        .distinct()
        .groupBy("kind")
        .count()
    )
    found = [
        problems(names.where(is_empty("name")), "empty definition name", F.col("regex")),
        problems(names.where(F.col("regex").isNull()), "definition without regex", F.col("name")),
        problems(
            names.groupBy("name").count().where("count > 1"),
            "duplicate definition name",
            F.col("name"),
        ),
        problems(entries.where(is_empty("class")), "empty class name", F.col("entry")),
        problems(entries.where(is_empty("entry")), "empty class entry", F.col("class")),
        problems(
            entries.groupBy("entry").count().where("count > 1"),
            "entry in more than one class",
            F.col("entry"),
        ),
        problems(
            sizes.where(F.col("count") > MAX_VOCABULARY),
            "vocabulary too large",
            F.concat_ws(" ", "kind", "count"),
        ),
    ]
    result = found[0]
    for more in found[1:]:
        result = result.union(more)
    return result

# Problems that an error message names; it tells how many there are.
SHOWN_PROBLEMS = 20


@dataclass(frozen=True)
class Model:
    """What a plan needs to know: names, regexes and word lists, as plain values.

    Short word lists are in ``entries``, longer ones in ``word_table``. In a model built with
    ``lookup="join"`` both are None and ``classes`` is looked up by join; ``word_filter`` tells which tokens
    cannot be in it.
    """

    definitions: tuple[tuple[str, str], ...]
    class_names: tuple[str, ...]
    entries: tuple[tuple[str, tuple[str, ...]], ...] | None
    word_table: LiteralTable | None
    word_filter: BitmapFilter | None
    classes: DataFrame
    blank_types: tuple[tuple[str, str | None], ...]

    @classmethod
    def from_tables(
        cls,
        definitions: DataFrame,
        classes: DataFrame,
        max_inline_entries: int = MAX_INLINE_ENTRIES,
        lookup: str = "inline",
        prefilter: bool = True,
    ) -> Model:
        """Check both tables and take the snapshot. Reads the model, no user data.

        With ``lookup="inline"`` the word lists are part of the plan, those above
        ``max_inline_entries`` as a literal table, and every operator is row-local; lists too long for
        that are refused. ``lookup="join"`` takes lists of any length and needs batches; its plans
        shuffle what may be in a list, by a bitmap of the entries unless ``prefilter`` is off.
        """
        if lookup not in LOOKUPS:
            raise ValueError(f"unknown lookup {lookup!r}, expected one of {', '.join(LOOKUPS)}")
        problems = validate_model(definitions, classes)
        bad = problems.limit(SHOWN_PROBLEMS + 1).collect()
        if bad:
            listed = "; ".join(f"{row.problem}: {row.detail}" for row in bad[:SHOWN_PROBLEMS])
            if len(bad) > SHOWN_PROBLEMS:
                listed += f"; {SHOWN_PROBLEMS} of {problems.count()} shown, validate_model() gives all"
            raise ValueError(f"invalid model: {listed}")
        ordered = tuple(
            (row.name, row.regex)
            for row in definitions.orderBy("ord").limit(MAX_VOCABULARY + 1).collect()
        )
        if not ordered:
            raise ValueError("invalid model: it has no definitions")
        classes = classes.select("class", "entry").distinct()
        class_names = tuple(
            sorted(row[0] for row in classes.select("class").distinct().limit(MAX_VOCABULARY + 1).collect())
        )
        entries = word_table = word_filter = None
        if lookup == "join":
            if prefilter:
                word_filter = BitmapFilter.build(classes, element_hash(F.col("entry")))
        elif classes.limit(max_inline_entries + 1).count() <= max_inline_entries:
            lists: dict[str, list[str]] = {name: [] for name in class_names}
            for row in classes.collect():
                lists[row[0]].append(row[1])
            entries = tuple((name, tuple(sorted(words))) for name, words in lists.items())
        else:
            word_table = LiteralTable.build(classes, "entry", "class")
            if word_table is None:
                raise ValueError("the word lists are too long for lookup='inline'; use lookup='join'")
        return cls(
            definitions=ordered,
            class_names=class_names,
            entries=entries,
            word_table=word_table,
            word_filter=word_filter,
            classes=classes,
            blank_types=_types_of_blanks(definitions.sparkSession, ordered),
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str, **options) -> Model:
        """Read a model folder with ``TOKENDEFINITION`` and ``TOKENCLASS`` below it."""
        try:
            return cls.from_tables(
                read_definitions(spark, f"{path}/TOKENDEFINITION"),
                read_classes(spark, f"{path}/TOKENCLASS"),
                **options,
            )
        except Exception as error:
            raise ValueError(f"no usable model in folder '{path}': {error}") from error

    @classmethod
    def from_values(
        cls,
        spark: SparkSession,
        definitions: Iterable[tuple[str, str]],
        classes: Mapping[str, Iterable[str]],
        **options,
    ) -> Model:
        """A model written down in code, for short lists."""
        ordered = [(i, name, regex) for i, (name, regex) in enumerate(definitions)]
        listed = [(name, word) for name, words in classes.items() for word in words]
        return cls.from_tables(
            spark.createDataFrame(ordered, DEFINITIONS_SCHEMA),
            spark.createDataFrame(listed, CLASSES_SCHEMA),
            **options,
        )

    @property
    def inline(self) -> bool:
        """Do rows find their classes without a join, as the model was asked to?"""
        return self.entries is not None or self.word_table is not None

    @cached_property
    def names(self) -> frozenset[str]:
        return frozenset(name for name, _ in self.definitions)

    @cached_property
    def type_values(self) -> tuple[str, ...]:
        """Type vocabulary; the id is the position. UTF-8 byte order, as in ``vocabulary``."""
        return tuple(sorted(self.names, key=str.encode))

    @cached_property
    def class_values(self) -> tuple[str, ...]:
        return tuple(sorted(self.names | set(self.class_names), key=str.encode))


def _types_of_blanks(spark, definitions):
    """What the definitions make of the usual blank tokens, found once per model.

    About half of all tokens are blanks, and without this each would run through
    every definition's regex. Also finds regexes that do not compile.
    """
    kinds = [definition_type(F.lit(blank), definitions).alias(str(i)) for i, blank in enumerate(COMMON_BLANKS)]
    try:
        row = spark.range(1).select(*kinds).first()
    except Exception as error:
        raise ValueError(f"invalid model: a definition's regex does not compile: {error}") from error
    return tuple(zip(COMMON_BLANKS, row, strict=True))
