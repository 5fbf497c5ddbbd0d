"""Rows from text documents: delimited reports, HTML tables and cards, workbook grids.

A grid has sheet, row, col, text and number (NULL where a cell isn't one). Its cells are carried along by windows within a
sheet, which is one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as fn


def fields(spark: SparkSession, path: str, sep: str, columns: int, header: bool = False, encoding: str = "UTF-8") -> DataFrame:
    """path and c0, c1, ... of each line of delimited files as trimmed strings; shorter lines end in NULLs."""
    schema = ", ".join(f"c{k} string" for k in range(columns))
    rows = spark.read.schema(schema).option("sep", sep).option("encoding", encoding).option("header", header).option("mode", "PERMISSIVE").option("enforceSchema", True).csv(path)
    return rows.select(F.col("_metadata.file_path").alias("path"), *[F.trim(f"c{k}").alias(f"c{k}") for k in range(columns)])


def export_rows(spark: SparkSession, path: str, columns: int, sep: str = "|", encoding: str = "ISO-8859-1") -> DataFrame:
    """Lines of delimited files of which some have a header and some don't: c0, c1, ..., texts trimmed and in upper case. A line whose
    first field is no number is a header."""
    lines = fields(spark, path, sep, columns, encoding=encoding)
    return lines.where(F.col("c0").try_cast("double").isNotNull()).select("path", *[F.upper(f"c{k}").alias(f"c{k}") for k in range(columns)])


def whole(column: str) -> Column:
    """A whole number that may be written with a decimal of zero; what is no number counts as 0."""
    return F.coalesce(F.col(column).try_cast("double").cast("long"), F.lit(0))


def code(column: str, width: int = 10) -> Column:
    """A code that a spreadsheet may have made a number of: without its decimal, with its leading zeros; NULL if it has other signs."""
    text = F.lpad(F.regexp_replace(F.trim(column), r"\.0$", ""), width, "0")
    return F.when(text.rlike(f"^[0-9]{{{width}}}$"), text)


def published_rates(lines: DataFrame, label: str, day: str, total: str, name: str) -> DataFrame:
    """fecha, rate of the lines of a report labelled `name`: a plausible rate in the total column, of the last such line of a day."""
    rate = plausible_rate(F.col(total))
    rows = lines.where(F.upper(F.trim(label)) == name).select(fn.any_date(F.col(day)).alias("fecha"), rate.alias("rate"))
    return rows.where("fecha IS NOT NULL AND rate IS NOT NULL").groupBy("fecha").agg(F.max("rate").alias("rate"))


def recomputed_rates(lines: DataFrame, day: str, price: str, amount: str) -> DataFrame:
    """fecha, rate: the mean of the detail lines' prices weighted by their amounts; lines with other labels have no price."""
    p, m = fn.spanish_number(F.col(price)), fn.spanish_number(F.col(amount))
    rows = lines.select(fn.any_date(F.col(day)).alias("fecha"), p.alias("p"), m.alias("m")).where("fecha IS NOT NULL AND p IS NOT NULL AND m > 0")
    return rows.groupBy("fecha").agg((F.sum(F.col("p") * F.col("m")) / F.sum("m")).alias("rate"))


def plausible_rate(text: Column, lo: float = 4.0, hi: float = 30.0) -> Column:
    """The first number with decimals in a text if it lies in lo..hi: a dot or a comma is the decimal mark; NULL otherwise."""
    token = F.regexp_extract(text, "([0-9]{1,2}[.,][0-9]{1,4})", 1)
    value = F.replace(token, F.lit(","), F.lit(".")).try_cast("double")
    return F.when(value.between(lo, hi), value)


def incident_file(spark: SparkSession, path: str) -> DataFrame:
    """The rows of headered incident files whose latitude and longitude are numbers, rounded to 5 places; others are skipped."""
    rows = spark.read.option("header", True).csv(path)
    place = lambda c: F.round(F.col(c).try_cast("double"), 5)
    return rows.withColumn("lat", place("lat")).withColumn("lon", place("lon")).where("lat IS NOT NULL AND lon IS NOT NULL")


def cells(row: Column) -> Column:
    """The trimmed texts of a table row's cells, in order."""
    return F.transform(F.regexp_extract_all(row, F.lit("(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), lambda c: fn.html_text(c))


def html_rows(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """key, row (from 0), cells of every table row."""
    rows = F.regexp_extract_all(html, F.lit("(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    return pages.select(key, F.posexplode(rows).alias("row", "r")).select(key, "row", cells(F.col("r")).alias("cells"))


def dated_values(rows: DataFrame, key: str = "page_id") -> DataFrame:
    """key, fecha, value of the table rows that begin with a date and a number: row-wise tables."""
    value = fn.spanish_number(F.get("cells", F.lit(1)))
    return rows.select(key, fn.any_date(F.get("cells", F.lit(0)), 1900).alias("fecha"), value.alias("value")).where("fecha IS NOT NULL AND value IS NOT NULL")


def transposed_values(rows: DataFrame, label: str, key: str = "page_id", first_year: int = 2025) -> DataFrame:
    """key, fecha, value: the row whose first cell has `label`, under a header of days such as 1-dic.

    The first row is the header. Days have no year: it is first_year, and one more each time the month falls.
    """
    first = rows.where("row = 0").select(key, F.col("cells").alias("heads"))
    mine = rows.where(F.get("cells", F.lit(0)).rlike(f"(?iu){label}")).groupBy(key).agg(F.min_by("cells", "row").alias("cells"))
    both = mine.join(first, key).select(key, F.slice("heads", F.lit(2), F.greatest(F.least(F.size("heads"), F.size("cells")) - 1, F.lit(0))).alias("heads"), "cells")
    heads = both.select(key, "cells", F.posexplode("heads").alias("k", "head"))
    month = fn.month_number(F.regexp_extract("head", "(?i)^ *[0-9]{1,2}-([a-z]{3})", 1), fn.SHORT_MONTHS)
    heads = heads.withColumn("m", month).where("m IS NOT NULL")
    order = Window.partitionBy(key).orderBy("k")  # one row of one page
    falls = F.coalesce((F.col("m") < F.lag("m").over(order)).cast("int"), F.lit(0))
    dated = heads.withColumn("falls", falls).withColumn("year", first_year + F.sum("falls").over(order))
    day = F.regexp_extract("head", "^ *([0-9]{1,2})", 1).cast("int")
    fecha = F.try_to_date(F.format_string("%04d-%02d-%02d", "year", "m", day), "yyyy-MM-dd")
    return dated.select(key, fecha.alias("fecha"), fn.spanish_number(F.get("cells", F.col("k") + 1)).alias("value")).where("fecha IS NOT NULL AND value IS NOT NULL")


def card_pairs(html: Column, mark: str = "num") -> Column:
    """Array of (fecha, value) of a card that changes its layout: all its days, sorted and different, with all its marked numbers, by
    position; numbers without a day and implausible ones are left out."""
    iso = F.transform(F.regexp_extract_all(html, F.lit('datetime="([0-9]{4}-[0-9]{2}-[0-9]{2})"'), F.lit(1)), lambda d: F.try_to_date(d, "yyyy-MM-dd"))
    written = F.regexp_extract_all(html, F.lit("(?iu)[0-9]{1,2} +de +[a-záéíóú]+(?: +de|,) +[0-9]{4}"), F.lit(0))
    spelled = F.transform(written, lambda d: fn.any_date(F.regexp_replace(d, ",", " de"), 1900))
    days = F.array_sort(F.array_distinct(F.array_compact(F.concat(iso, spelled))))
    numbers = F.regexp_extract_all(html, F.lit(f'{mark}"[^>]*>\\s*([0-9.]*[0-9][,.][0-9]+)\\s*<'), F.lit(1))
    pairs = F.transform(days, lambda d, k: F.struct(d.alias("fecha"), plausible_rate(F.get(numbers, k)).alias("value")))
    return F.filter(pairs, lambda p: p["value"].isNotNull())


def heading_links(pages: DataFrame, most: int = 40, least: int = 15, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """key, place, title, link: the links in headings (h2, h3) with a title of `least` characters or more, made absolute, each
    once on its page, the first `most` of them."""
    heads = F.flatten(F.transform(F.regexp_extract_all(html, F.lit("(?is)<h[23][^>]*>(.*?)</h[23]>"), F.lit(1)), lambda h: F.regexp_extract_all(h, F.lit("(?is)<a\\s[^>]*href\\s*=\\s*[\"'][^\"']*[\"'][^>]*>.*?</a>"), F.lit(0))))
    link = lambda a: F.regexp_extract(a, "(?is)href\\s*=\\s*[\"']([^\"']*)[\"']", 1)
    made = F.transform(heads, lambda a: F.struct(fn.html_text(a).alias("title"), fn.absolute_url(link(a), F.col(url)).alias("link")))
    good = F.filter(made, lambda x: (F.length(x["title"]) >= least) & x["link"].isNotNull())
    once = F.filter(good, lambda x, k: F.array_position(F.transform(good, lambda y: y["link"]), x["link"]) == k + 1)
    return pages.select(key, F.posexplode(F.slice(once, 1, most)).alias("place", "x")).select(key, "place", "x.title", "x.link")


def _carried(value: Column, order: Window) -> Column:
    return F.last(value, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))


def month_rows(grid: DataFrame, footer: str = "fuente") -> DataFrame:
    """The grid's rows whose first cell is a month, with month (1 to 12), above the first footer: totals and notes are dropped."""
    first = grid.where("col = 0").select("sheet", "row", fn.month_number(F.trim("text"), fn.MONTHS).alias("month"), F.lower(F.trim("text")).startswith(footer).alias("foot"))
    ends = first.groupBy("sheet").agg(F.min(F.when(F.col("foot"), F.col("row"))).alias("end"))
    good = first.where("month IS NOT NULL").join(ends, "sheet").where("end IS NULL OR row < end").select("sheet", "row", "month")
    return grid.join(good, ["sheet", "row"])


def year_rows(grid: DataFrame, footer: str = "fuente") -> DataFrame:
    """sheet, row, periodo, preliminary: year and quarter labels of the first column; a quarter takes the year above it, with its
    mark of preliminary. Other labels have no period; a footer ends the block."""
    order = Window.partitionBy("sheet").orderBy("row")
    first = grid.where("col = 0 AND text IS NOT NULL").select("sheet", "row", F.trim("text").alias("text"))
    own = F.regexp_extract("text", r"(?i)^([0-9]{4})\s*(\(?\s*p\s*\)?)?$", 1)
    marked = first.withColumn("y", F.when(own != "", F.struct(own.cast("int").alias("year"), fn.is_preliminary(F.col("text")).alias("p"))))
    marked = marked.withColumn("year", _carried(F.col("y"), order)).withColumn("over", F.max(F.lower("text").startswith(footer).cast("int")).over(order))
    rows = marked.where("over = 0").select("sheet", "row", fn.period_of_label(F.col("text"), F.col("year.year")).alias("periodo"), F.col("year.p").alias("preliminary"))
    return rows.where("periodo IS NOT NULL")


def two_band_periods(grid: DataFrame, year_row: int, month_row: int) -> DataFrame:
    """sheet, col, periodo (yyyy-MM) of a header of years over months; a year stands over all months up to the next one."""
    order = Window.partitionBy("sheet").orderBy("col")
    heads = grid.where(F.col("row").isin(year_row, month_row)).groupBy("sheet", "col").agg(F.max(F.when(F.col("row") == year_row, F.col("text"))).alias("y"), F.max(F.when(F.col("row") == month_row, F.col("text"))).alias("m"))
    own = F.regexp_extract("y", r"(?i)^\s*([0-9]{4})\s*(\(?\s*p\s*\)?)?\s*$", 1)
    heads = heads.withColumn("year", _carried(F.when(own != "", own), order)).withColumn("month", fn.month_number(F.trim("m"), fn.MONTHS))
    return heads.where("year IS NOT NULL AND month IS NOT NULL").select("sheet", "col", F.format_string("%s-%02d", "year", "month").alias("periodo"))


def joined_labels(labels: DataFrame) -> DataFrame:
    """sheet, row, label of the rows with values: a label without values is a first line of the next row's label.

    labels has sheet, row, label (NULL for an empty line), valued. Of several labels without values in a row the last one
    counts; empty lines between don't matter.
    """
    order = Window.partitionBy("sheet").orderBy("row")
    rows = labels.where("label IS NOT NULL AND trim(label) <> ''")
    before = F.lag(F.struct("label", "valued")).over(order)
    rows = rows.withColumn("before", before).where("valued")
    whole = F.when(F.col("before.valued") == F.lit(False), F.concat_ws(" ", F.trim("before.label"), F.trim("label"))).otherwise(F.trim("label"))
    return rows.select("sheet", "row", whole.alias("label"))


def filled(rows: DataFrame, key: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """rows with the columns' last value carried down over NULLs, within the key: merged header cells."""
    by = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumns({c: _carried(F.col(c), by) for c in columns})
