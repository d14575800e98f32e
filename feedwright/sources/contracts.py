"""The NOT NULL contract of the source tables, which file sources do not enforce."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.schemas import TABLES, required_columns


def contract_violations(df: DataFrame, name: str) -> DataFrame:
    """Nulls in each mandatory column of table `name`, from one aggregate."""
    required = required_columns(TABLES[name])
    counted = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in required))
    return counted.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.col(c).alias("null_rows")
                    )
                    for c in required
                )
            )
        )
    )


def with_violations(df: DataFrame, name: str) -> DataFrame:
    """The rows with the names of their null mandatory columns; null where the contract is kept."""
    required = required_columns(TABLES[name])
    named = F.concat_ws(";", *(F.when(F.col(c).isNull(), c) for c in required))
    return df.withColumn("violations", F.when(named != "", named))


def split_by_contract(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows that keep the contract, and the others with the names of their null columns.

    Both read `df`; if that is dear to read, store `with_violations` of it and split that.
    """
    return split_marked(with_violations(df, name))


def split_marked(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    return marked.filter("violations IS NULL").drop("violations"), marked.filter("violations IS NOT NULL")


def enforce_contract(df: DataFrame, name: str) -> DataFrame:
    """The same rows; the job that reads a null in a mandatory column fails. Takes no extra pass."""

    def required(c: str):
        message = F.lit(f"NOT NULL contract: {name}.{c} is null")
        return F.when(F.col(c).isNull(), F.raise_error(message).cast(df.schema[c].dataType)).otherwise(F.col(c))

    return df.withColumns({c: required(c) for c in required_columns(TABLES[name])})
