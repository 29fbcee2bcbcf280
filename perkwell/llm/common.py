"""Column helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WORD_BREAK = r"[^\p{L}\p{N}]+"
SHINGLE_WORDS = 5
SIMILAR = 0.8


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(column), F.lit(""))


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.filter(F.split(F.lower(text), WORD_BREAK), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once.

    An expression used inside a lambda is otherwise evaluated again for every element.
    """
    return F.transform(F.array(value), body)[0]


def shingles(word_list: Column, n: int = SHINGLE_WORDS) -> Column:
    """All runs of ``n`` words joined by blanks, without repeats; none where there are fewer words."""
    def runs(w: Column) -> Column:
        last = F.size(w) - n
        every = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.concat_ws(
            " ", *[F.get(w, i + k) for k in range(n)]
        ))
        return F.when(last >= 0, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))

    return let(word_list, runs)


def salted_join(many: DataFrame, few: DataFrame, on: list[str], row: str, salts: int, how: str = "inner") -> DataFrame:
    """Equi-join where one key may hold most rows of ``many``.

    Rows of ``many`` are dealt over ``salts`` parts of their key by a hash of ``row``;
    ``few`` is repeated once per part.
    """
    part = F.pmod(F.xxhash64(row), F.lit(salts)).cast("int")
    parts = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return many.withColumn("_salt", part).join(few.withColumn("_salt", parts), [*on, "_salt"], how).drop("_salt")
