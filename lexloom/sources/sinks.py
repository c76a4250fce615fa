"""Writers, chat shapes, manifests, reports and round trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One object per line, nulls written out."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def canonical_json(columns: Sequence[str]) -> Column:
    """A row as JSON with its keys in order."""
    return F.to_json(F.struct(*sorted(columns)))


def by_split(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).partitionBy("split").parquet(path)


def parquet(df: DataFrame, path: str, mode: str = "errorifexists", rows_per_file: int = 1_000_000) -> None:
    df.write.mode(mode).option("compression", "snappy").option("maxRecordsPerFile", rows_per_file).parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Rows added to a log of Parquet files."""
    df.write.mode("append").parquet(path)


def chat_formats(system: Column, user: Column, assistant: Column) -> dict[str, Column]:
    """A turn in four shapes: alpaca, sharegpt, chatml and huggingface."""
    def said(role: str, c: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), c.alias("content"))

    def from_(who: str, c: Column) -> Column:
        return F.struct(F.lit(who).alias("from"), c.alias("value"))

    def marked(role: str, c: Column) -> Column:
        return F.concat(F.lit(f"<|im_start|>{role}\n"), c, F.lit("<|im_end|>"))

    text = F.concat_ws("\n", marked("system", system), marked("user", user), marked("assistant", assistant))
    return {
        "alpaca": F.to_json(F.struct(system.alias("instruction"), user.alias("input"), assistant.alias("output"))),
        "sharegpt": F.to_json(F.struct(F.array(from_("system", system), from_("human", user), from_("gpt", assistant)).alias("conversations"))),
        "chatml": F.to_json(F.struct(F.array(said("system", system), said("user", user), said("assistant", assistant)).alias("messages"))),
        "huggingface": F.to_json(F.struct(text.alias("text"))),
    }


def round_trip(df: DataFrame, path: str) -> dict:
    """Write, read again and compare rows and schema."""
    parquet(df, path)
    back = df.sparkSession.read.parquet(path)
    plain = lambda d: [(f.name, f.dataType.simpleString()) for f in d.schema]
    return {"rows": back.count(), "rows_equal": df.count() == back.count(), "schema_equal": plain(df) == plain(back)}


def safe_scalars(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for formats that know only plain ones."""
    return df.select(*(F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("struct", "array", "map") else F.col(f.name) for f in df.schema))


def csv_report(df: DataFrame, path: str) -> None:
    """A small aggregate as one CSV file."""
    df.coalesce(1).write.option("header", "true").csv(path)


def markdown(df: DataFrame, title: str, most: int = 1000) -> str:
    """A small aggregate as a Markdown table; more than ``most`` rows are an error, since a report is no export."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of more than {most} rows")
    out = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(out + ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows]) + "\n"


def reliability_svg(bins: Sequence[tuple[float, float, int]], size: int = 300) -> str:
    """A reliability diagram of (mean confidence, mean target, rows)."""
    dots = "".join(f'<circle cx="{c * size:.1f}" cy="{(1 - t) * size:.1f}" r="{2 + min(8, n**0.5 / 4):.1f}"/>' for c, t, n in bins if n)
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{size}" height="{size}"><line x1="0" y1="{size}" x2="{size}" y2="0" stroke="gray"/>{dots}</svg>'


def manifest(df: DataFrame, path_col: str = "path") -> DataFrame:
    """Hash of every file of a binary source, by path."""
    return df.select(path_col, F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


def write_text(df: DataFrame, path: str, text: str) -> None:
    """A small text written beside its final name and renamed, through the file system of the path."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    final, part = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + ".part")
    fs = final.getFileSystem(conf)
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(final, False)
    if not fs.rename(part, final):
        raise OSError(f"could not rename to {path}")
