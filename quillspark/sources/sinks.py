"""Writers: one file per row, outlines and reports as small CSV files, manifests."""

from __future__ import annotations

import csv
import io
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.session import ship

OUTLINE_HEADER = ["RID", *["Position"] * 4, "part type", "label", "titles", "work", "notes", "colophon", "authorshipStatement", "identifiers", "etext start", "etext end", "img grp start", "img grp end"]


def write_files(df: DataFrame, root: str, path: str = "path", content: str = "content") -> DataFrame:
    """Writes each row's content (text or binary) below ``root`` by the file system of ``root``'s scheme; returns
    what was written: ``path, n_bytes``. Null content gives an empty file.

    Rows are written where they are, each by a name of its own that is renamed, so retried tasks and attempts
    that run side by side are harmless. Call an action on the result. Roots other than shared local folders need
    pyarrow's file system for them.
    """
    import pyarrow as pa

    def write(batches):
        from pyarrow import fs

        system, top = fs.FileSystem.from_uri(root)
        for batch in batches:
            made = [(x or b"") for x in batch.column(1).to_pylist()]
            for name, raw in zip(batch.column(0).to_pylist(), made):
                target = f"{top.rstrip('/')}/{name}"
                part = f"{target}.{uuid.uuid4().hex}.part"
                system.create_dir(target.rpartition("/")[0], recursive=True)
                with system.open_output_stream(part) as f:
                    f.write(raw)
                system.move(part, target)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in made], pa.int64())], ["path", "n_bytes"])

    ship(df.sparkSession)
    return df.select(F.col(path).cast("string"), F.col(content).cast("binary")).mapInArrow(write, "path string, n_bytes long")


def csv_text(header: list[str], rows: list[list]) -> str:
    """Text of a small CSV: CRLF, minimal quoting, duplicate headers allowed. For outlines, which are people's work."""
    out = io.StringIO()
    writer = csv.writer(out)
    writer.writerow(header)
    writer.writerows(rows)
    return out.getvalue()


def csv_line(cells: Column) -> Column:
    """An array of texts as a CSV line, quoted where needed; null is empty."""
    quoted = lambda c: F.when(c.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    return F.array_join(F.transform(cells, lambda c: quoted(F.coalesce(c, F.lit("")))), ",")


def csv_files(rows: DataFrame, key: str, order: list[str], cells: Column, header: list[str], suffix: str = ".csv", quote: bool = True) -> DataFrame:
    """``path, content`` of a CSV for each ``key``: a header and a line per row by ``order``, for ``write_files``.

    ``cells`` is an array of texts. ``quote=False`` puts commas between the values as they are.
    """
    line = csv_line(cells) if quote else F.array_join(F.transform(cells, lambda c: F.coalesce(c, F.lit(""))), ",")
    lines = rows.select(F.col(key).cast("string").alias("_key"), F.struct(*order, line.alias("_line")).alias("_row"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list("_row")), lambda r: F.concat(r["_line"], F.lit("\r\n" if quote else "\n"))), "")  # one outline's rows
    head = csv_text(header, []) if quote else ",".join(header) + "\n"
    return lines.groupBy("_key").agg(text.alias("_text")).select(F.concat("_key", F.lit(suffix)).alias("path"), F.concat(F.lit(head), F.col("_text")).alias("content"))


def with_images(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``folder, pos, cells`` of rows with their own columns and then the four image columns, as texts."""
    more = [F.col("volnum"), F.col("volnum"), F.col("imgnum_start"), F.col("imgnum_end")]
    return rows.select("folder", "pos", F.array(*[F.col(c).cast("string") for c in columns], *[c.cast("string") for c in more]).alias("cells"))


def unquoted_csv(columns: list[Column]) -> Column:
    """A line of values with commas between, not quoted."""
    return F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def div_outline(divs: DataFrame) -> DataFrame:
    """Outline rows of 17 cells from ``ie_id, ve_id, vol_num, seq, level, title, start_id, end_id``.

    Several volumes: a V row for each and positions one further. Level 1 is T, level 2 is C.
    """
    many = divs.groupBy("ie_id").agg(F.countDistinct("ve_id").alias("n"))
    rows = divs.join(many, "ie_id")
    place = F.col("level") + F.when(F.col("n") > 1, 1).otherwise(0)
    vol = F.col("vol_num").cast("string")
    blank = [F.lit("")] * 6

    def cells(mark, kind, label, start, end):
        return F.array(F.lit(""), *[F.when(mark == i, "X").otherwise("") for i in range(1, 5)], kind, label, *blank, start, end, vol, vol)

    body = rows.where("level in (1, 2)").select("ie_id", "vol_num", F.col("seq").cast("long").alias("seq"), cells(place, F.when(F.col("level") == 1, "T").otherwise("C"), F.col("title"), F.col("start_id"), F.col("end_id")).alias("cells"))
    heads = rows.where("n > 1").select("ie_id", "vol_num", F.lit(0).cast("long").alias("seq"), cells(F.lit(1), F.lit("V"), F.concat(F.lit("Volume "), vol), F.lit(""), F.lit("")).alias("cells")).distinct()
    return heads.unionByName(body)


def milestone_outline(marks: DataFrame) -> DataFrame:
    """Outline rows of 17 cells from ``ie_id, vol_num, seq, id, end_id``: a V row for each volume, T rows below."""
    vol = F.col("vol_num").cast("string")
    ref = lambda c: F.when(F.col(c) == "", "").otherwise(F.concat(F.lit("1#"), F.col(c)))
    blank = [F.lit("")] * 6
    body = marks.select("ie_id", "vol_num", F.col("seq").cast("long").alias("seq"), F.array(F.lit(""), F.lit(""), F.lit("X"), F.lit(""), F.lit(""), F.lit("T"), F.col("id"), *blank, ref("id"), ref("end_id"), vol, vol).alias("cells"))
    heads = marks.select("ie_id", "vol_num", F.lit(0).cast("long").alias("seq"), F.array(F.lit(""), F.lit("X"), *[F.lit("")] * 3, F.lit("V"), F.concat(F.lit("Volume "), vol), *blank, F.lit(""), F.lit(""), vol, vol).alias("cells")).distinct()
    return heads.unionByName(body)


def sample_rows(df: DataFrame, by: list[str], key: str, n: int = 2, seed: int = 42) -> DataFrame:
    """At most ``n`` rows of each group, by a seeded hash of the key."""
    w = Window.partitionBy(*by).orderBy(F.xxhash64(key, F.lit(seed)), key)
    return df.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= n).drop("_k")
