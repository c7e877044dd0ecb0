"""Listing extraction from stored pages — one executor-side job over all pages.

``listing_rows``  generic: every ``row_tag`` element of every page, with the
                  ``cell_tag`` cells inside it (used with li/a on the driver
                  pages).
``table_listings`` the listing-table layout: first ``<table>``, its ``<tbody>``,
                  every ``<tr>`` of it with at least 66 ``<td>`` of its own (a
                  table inside a cell is part of that cell); cells are parsed by
                  index into the master columns, rows with Value or Wage 0 are
                  dropped and unparsable money marks a reject.
``page_manifest`` the paginated URL list (offset step of 60) joined to the
                  stored page table; nothing is fetched.
``page_runs``     which page numbers of each listing are stored: runs, gaps, repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valorem import schema as S
from valorem.functions import clean, html
from valorem.session import materialize


def listing_rows(pages: DataFrame, row_tag: str = "li", cell_tag: str = "a") -> DataFrame:
    body = html.strip_noise(F.col("html"))
    rows = pages.select("page_id", F.posexplode(html.elements(body, row_tag)).alias("row_index", "row_html"))
    cells = html.elements(F.col("row_html"), cell_tag)
    return rows.select(
        "page_id",
        F.col("row_index").cast("int").alias("row_index"),
        F.size(cells).cast("int").alias("n_cells"),
        html.anchor_text(F.col("row_html")).alias("first_text"),
        html.anchor_href(F.col("row_html")).alias("href"),
    )


def _once(value: Column) -> Column:
    """The value through a generator: filters above are not pushed below it, which would repeat its expression."""
    return F.explode(F.array(value))


def table_rows(pages: DataFrame) -> DataFrame:
    """page_id, row_index, cells (inner HTML) of every row of each page's first table, by nesting depth."""
    first = F.slice(html.nested_elements(html.strip_noise(F.col("html")), "table"), 1, 1)
    body = F.coalesce(F.get(html.nested_elements(F.col("inner"), "tbody"), F.lit(0)), F.col("inner"))
    return (pages.select("page_id", F.explode(first).alias("inner"))
            .select("page_id", _once(body).alias("body"))
            .select("page_id", F.posexplode(html.nested_elements(F.col("body"), "tr")).alias("row_index", "row_html"))
            .select("page_id", "row_index", _once(html.nested_elements(F.col("row_html"), "td")).alias("cells")))


def table_listings(pages: DataFrame, with_rejects: bool = False) -> DataFrame:
    """Master rows (scraper column order) from listing tables.

    With ``with_rejects`` the rows whose money text could not be parsed are
    kept with ``rejected = true`` instead of being dropped.
    """
    # the texts of the cells that have a field, once; the fields below take them by index
    used = [S.CELL_AGE, S.CELL_OVERALL, S.CELL_POTENTIAL, S.CELL_ID, S.CELL_POSITION, S.CELL_CONTRACT, S.CELL_VALUE, S.CELL_WAGE,
            *S.TOTAL_CELLS, *S.STAT_CELLS]
    rows = (table_rows(pages).filter(F.size("cells") >= S.MIN_CELLS)
            .select("page_id", "row_index", _once(F.struct(
                F.transform(F.array(*[F.get("cells", F.lit(i)) for i in used]), html.text).alias("texts"),
                html.anchor_text(F.get("cells", F.lit(S.CELL_NAME))).alias("name"),
                html.anchor_text(F.get("cells", F.lit(S.CELL_TEAM))).alias("team"))).alias("c"))
            .select("page_id", "row_index", "c.*"))

    def txt(i: int) -> Column:
        return F.get(F.col("texts"), F.lit(used.index(i)))

    fields = {
        "Name": F.col("name"),
        "ID": txt(S.CELL_ID),
        "Age": clean.digits_int(txt(S.CELL_AGE)),
        "Overall rating": clean.leading_int(txt(S.CELL_OVERALL)),
        "Potential": clean.leading_int(txt(S.CELL_POTENTIAL)),
        "Team": clean.team(F.col("team"), txt(S.CELL_CONTRACT)),
        "Position category": clean.position_category(txt(S.CELL_POSITION)),
    }
    for col, idx in zip(S.TOTAL_COLUMNS + S.STAT_COLUMNS, S.TOTAL_CELLS + S.STAT_CELLS):
        fields[col] = clean.digits_int(txt(idx))
    priced = clean.with_money(rows, {"Value": txt(S.CELL_VALUE), "Wage": txt(S.CELL_WAGE)})
    priced = priced.select(*rows.columns, _once(F.struct("Value", "Wage")).alias("money"))
    out = priced.select("page_id", "row_index", *[(fields[c] if c in fields else F.col("money")[c]).alias(c) for c in S.MESSAGE_COLUMNS])
    out = out.withColumn("rejected", F.col("Value").isNull() | F.col("Wage").isNull())
    kept = out.filter(F.col("rejected") | ((F.col("Value") != 0) & (F.col("Wage") != 0)))
    return kept if with_rejects else kept.filter(~F.col("rejected")).drop("rejected")


def page_manifest(spark: SparkSession, base_url: str, max_pages: int) -> DataFrame:
    """(page_no, url) for offsets 0, 60, ... of a paginated listing: the urls to fetch."""
    return spark.range(0, max_pages * S.PAGE_ROWS, S.PAGE_ROWS).select(
        (F.col("id") / S.PAGE_ROWS).cast("int").alias("page_no"),
        F.concat(F.lit(base_url), F.col("id").cast("string")).alias("url"))


def manifest_pages(pages: DataFrame, base_url: str, max_pages: int | None = None) -> DataFrame:
    """Stored pages of a paginated listing with their page number: every page whose url is
    ``base_url`` and an offset 0, 60, ... (with ``max_pages`` only the first so many)."""
    offset = F.substring("url", len(base_url) + 1, 30)
    number = F.when(F.startswith("url", F.lit(base_url)) & offset.rlike("^(0|[1-9][0-9]*)$"), offset.try_cast("bigint"))
    out = (pages.withColumn("page_no", number / S.PAGE_ROWS)
           .filter(F.col("page_no").isNotNull() & (F.col("page_no") == F.floor("page_no")))
           .withColumn("page_no", F.col("page_no").cast("int")))
    return out.filter(F.col("page_no") < max_pages) if max_pages is not None else out


def _over_ranges(ends: DataFrame, value: str, name: str) -> DataFrame:
    """part, ``name``: ``value`` of each row, an expression of its place ``i`` in the array ``a`` of all rows by part (one a range)."""
    rows = ends.agg(F.array_sort(F.collect_list(F.struct("part", *[c for c in ends.columns if c != "part"]))).alias("a"))
    return rows.select(F.inline(F.expr(f"transform(a, (x, i) -> struct(x.part as part, {value} as {name}))")))


def page_runs(numbered: DataFrame, listing: str = "listing", number: str = "page_no") -> DataFrame:
    """listing, first_page, last_page, n_pages, n_repeats, gap_before: runs of consecutive page numbers of each listing.

    ``gap_before`` is the number of pages missing since the run before (null
    for a listing's first run), ``n_repeats`` the stored pages beyond the first
    of each number. Pages without a number don't count; a null listing is one.

    A prefix scan over ranges, so that a huge listing is many tasks: each range
    of (listing, page) looks back within itself, and its first row to the last
    one of the ranges before. Only those ends, one row a range, meet in one task.
    """
    page = F.struct(F.col(listing).alias("listing"), F.col(number).cast("long").alias("page_no"))
    seen = (numbered.select(page.alias("p")).filter("p.page_no is not null").groupBy("p").agg(F.count(F.lit(1)).alias("copies")))
    # The numbers of the ranges are kept with the rows: sampling again could move the borders.
    ranged = materialize(seen.repartitionByRange("p").withColumn("part", F.spark_partition_id()))
    ends = _over_ranges(ranged.groupBy("part").agg(F.max("p").alias("last")),
                        "if(i = 0, null, a[i - 1].last)", "end_before")
    looked = (ranged.withColumn("before", F.lag("p").over(Window.partitionBy("part").orderBy("p")))
              .join(F.broadcast(ends), "part").withColumn("before", F.coalesce("before", "end_before")))
    same = F.col("p.listing").eqNullSafe(F.col("before.listing")) & F.col("before").isNotNull()
    gap = F.when(same, F.col("p.page_no") - F.col("before.page_no") - 1)
    marked = looked.select("part", "p", "copies", gap.alias("gap"), F.when(gap == 0, 0).otherwise(1).alias("starts"))
    totals = _over_ranges(marked.groupBy("part").agg(F.sum("starts").alias("n")),
                          "aggregate(slice(a, 1, i), 0L, (sum, y) -> sum + y.n)", "runs_before")
    run = F.sum("starts").over(Window.partitionBy("part").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)) + F.col("runs_before")
    return (marked.join(F.broadcast(totals), "part").withColumn("run", run)
            .groupBy("run").agg(F.min("p").alias("first"), F.max("p.page_no").alias("last_page"), F.count(F.lit(1)).alias("n_pages"),
                                F.sum(F.col("copies") - 1).alias("n_repeats"), F.max(F.when(F.col("starts") == 1, F.col("gap"))).alias("gap_before"))
            .select(F.col("first.listing").alias("listing"), F.col("first.page_no").alias("first_page"), "last_page", "n_pages", "n_repeats", "gap_before"))


def extraction_status(pages: DataFrame, row_tag: str = "li", cell_tag: str = "a") -> DataFrame:
    """One status row for an extraction run: pages read, pages that yielded no
    row, rows and cells extracted. An empty run is reported, not silent, and
    the caller decides what to do with it. One aggregate pass over the pages."""
    body = html.strip_noise(F.col("html"))
    rows = html.elements(body, row_tag)
    per_page = pages.select(
        F.size(rows).alias("n_rows"),
        F.aggregate(F.transform(rows, lambda r: F.size(html.elements(r, cell_tag))), F.lit(0),
                    lambda acc, x: acc + x).alias("n_cells"))
    return per_page.agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("n_rows") == 0).alias("pages_without_rows"),
        F.sum("n_rows").cast("bigint").alias("rows"),
        F.sum("n_cells").cast("bigint").alias("cells"))
