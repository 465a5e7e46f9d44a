"""Stored postings for search: an inverted index as Parquet tables, kept up with every save.

Below the root every indexed batch is one numbered folder with four tables:

* ``postings``: one row per (term, block): the number of posts, the largest term
  count, the smallest post length and the posts themselves.  A block is at most
  ``block_rows`` posts that lie behind one another in ``posts``, the same posts for
  all terms; one that two tasks read has a row for each part.  Terms are
  dealt to folders by a hash and sorted in each file, so that a filter on terms
  reads the folders, row groups and pages of these terms only.
* ``posts``: key, block, length and word counts of every post of the batch.
* ``dead``: posts of earlier batches that this batch replaces.
* ``figures``: number of posts and words; written last, it commits the folder.

``full-<number>`` starts anew, ``part-<number>`` adds to what is there.
"""

from __future__ import annotations

import datetime as dt
import zlib
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.arrow import count_words, invert
from ..functions.text import TextOptions, tokens
from ..operators.rank import post_rank, top_rows, within
from ..operators.search import RELEVANCE, SEARCH_ORDERS, query_terms
from ..operators.sizing import spread
from ..session import bound_batches, cut_lineage

_BLOCK = ["segment", "block"]
#: Folders of a table of postings.
_BUCKETS = 64


def _bucket(term: str) -> Column:
    return F.pmod(F.crc32(F.col(term)), F.lit(_BUCKETS)).cast("int")


class SearchIndex:
    """The postings of one table, searched by BM25 (see ``operators.search``).

    ``fields`` are the indexed columns, joined by blanks.  One writer at a time;
    a folder without its figures is not read, and the next update replaces it.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        key: str = "id",
        fields: Sequence[str] = ("title", "selftext"),
        options: TextOptions | None = None,
        block_rows: int = 128,
    ):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.fields, self.options = tuple(fields), options or TextOptions()
        self.block_rows = block_rows

    # Folders -----------------------------------------------------------------

    def _segments(self) -> list[tuple[int, str]]:
        """The folders that make up the index, oldest first."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        done = lambda n: fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{n}/figures/_SUCCESS"))
        found = sorted((int(n.partition("-")[2]), n) for n in names if n.startswith(("full-", "part-")) and done(n))
        fulls = [i for i, (_, n) in enumerate(found) if n.startswith("full-")]
        return found[fulls[-1] :] if fulls else []

    @property
    def version(self) -> int | None:
        """Number of the newest batch, None for an empty index."""
        return max((n for n, _ in self._segments()), default=None)

    def _table(self, name: str, schema: str) -> DataFrame:
        """One table of all folders, with the folder's number as ``segment``."""
        parts = [
            self.spark.read.parquet(f"{self.root}/{folder}/{name}").withColumn("segment", F.lit(number))
            for number, folder in self._segments()
        ]
        if not parts:
            return self.spark.createDataFrame([], schema + ", segment int")
        return reduce(DataFrame.unionByName, parts)

    # Writing -----------------------------------------------------------------

    def update(self, rows: DataFrame, number: int | None = None, whole: bool = False) -> int:
        """Index the rows of a batch, complete and one per key; posts indexed before under these keys are replaced.

        With ``whole`` the rows are the whole table.  The texts of other posts are not
        read: only keys and lengths of the posts indexed so far are looked up.
        """
        before = self._segments()
        number = number or (before[-1][0] + 1 if before else 1)
        whole = whole or not before
        path = f"{self.root}/{'full' if whole else 'part'}-{number:08d}"
        rows = rows.where(F.col(self.key).isNotNull())
        bound_batches(self.spark)
        # Blocks are runs of posts as they are written: postings are made where a block lies.
        block = F.expr(f"monotonically_increasing_id() DIV {self.block_rows}")
        text = F.concat_ws(" ", *[F.col(f) for f in self.fields])
        words = spread(rows).select(F.col(self.key).alias("key"), block.alias("block"), tokens(text, self.options).alias("w"))
        # Words are cut out once: the counts of a post are kept, the postings are made from them.
        self._write(self._counted(words), path, "posts")
        posts = self.spark.read.parquet(f"{path}/posts")
        sized = posts.select("key", "block", "length")
        if not whole:
            self._write(self._replaced(sized.select("key")), path, "dead")
        else:
            kind = rows.schema[self.key].dataType.simpleString()
            self._write(self.spark.createDataFrame([], f"key {kind}, block long, length int, of int"), path, "dead")
        figures = sized.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0).cast("long")).alias("words"))
        slices = -(-figures.first()["n"] // 1_000_000)
        self._write(self._postings(posts, slices), path, "postings", "bucket")
        self._write(figures, path, "figures")
        return number

    @staticmethod
    def _write(df: DataFrame, path: str, name: str, *by: str) -> None:
        df.write.mode("overwrite").partitionBy(*by).option("compression", "zstd").parquet(f"{path}/{name}")

    def _replaced(self, keys: DataFrame) -> DataFrame:
        """The posts indexed under these keys that are not dead yet."""
        alive = self._alive()
        return alive.join(keys, "key", "left_semi").select("key", "block", "length", F.col("segment").alias("of"))

    def _alive(self) -> DataFrame:
        posts = self._table("posts", "key string, block long, length int")
        dead = self._dead().select("key", F.col("of").alias("segment"))
        return posts.join(dead, ["key", "segment"], "left_anti")

    def _dead(self) -> DataFrame:
        return self._table("dead", "key string, block long, length int, of int").drop("segment")

    @staticmethod
    def _counted(words: DataFrame) -> DataFrame:
        """(key, block, length, terms, counts): the different words of each post and how often each occurs."""
        kind = words.schema["key"].dataType.simpleString()

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = batch.column("w")
                columns = [batch.column("key"), batch.column("block"), found.value_lengths(), *count_words(found)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "block", "length", "terms", "counts"])

        return words.mapInArrow(run, f"key {kind}, block long, length int, terms array<string>, counts array<int>")

    @staticmethod
    def _postings(posts: DataFrame, slices: int) -> DataFrame:
        """Postings by (term, block) from the counts of the posts.

        They are made of whole blocks, so what is shuffled is a row for each term and block.  Terms lie in
        buckets by their hash; in a large batch each bucket is cut into slices of blocks, so
        the most frequent term is the work of many tasks.
        """
        kind = posts.schema["key"].dataType.simpleString()

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []  # the posts of the block that a batch ends in
            for batch in batches:
                if not batch.num_rows:
                    continue
                blocks = batch.column("block").to_numpy()
                begin = int((blocks[::-1] != blocks[-1]).argmax())  # posts of the last block
                begin = batch.num_rows - begin if blocks[0] != blocks[-1] else 0
                if begin or (held and held[-1].column("block")[0].as_py() != blocks[0]):
                    yield invert(pa.concat_batches([*held, batch.slice(0, begin)]))
                    held = []
                held.append(batch.slice(begin))
            if held:
                yield invert(pa.concat_batches(held))

        schema = f"term string, block long, n long, max_tf int, min_length int, key array<{kind}>, tf array<int>, length array<int>"
        made = posts.mapInArrow(run, schema)
        dealt_by = {"bucket": _bucket("term")}
        if slices > 1:
            dealt_by["slice"] = F.pmod(F.xxhash64("block"), F.lit(slices))
        dealt = made.withColumns(dealt_by).repartition(*dealt_by).sortWithinPartitions("bucket", "term", "block")
        listed = F.arrays_zip("key", "tf", "length").alias("posts")
        return dealt.select("bucket", "term", "block", "n", "max_tf", "min_length", listed)

    # Reading -----------------------------------------------------------------

    def postings(self, terms: Sequence[str]) -> DataFrame:
        """The stored rows of these terms; the filter reaches the scan."""
        kind = "array<struct<key: string, tf: int, length: int>>"
        table = self._table("postings", f"term string, block long, n long, max_tf int, min_length int, posts {kind}, bucket int")
        folders = sorted({zlib.crc32(t.encode()) % _BUCKETS for t in terms})
        return table.where(F.col("bucket").isin(folders) & F.col("term").isin(list(terms))).drop("bucket")

    def _figures(self, terms: Sequence[str]) -> tuple[int, float, dict[str, int]]:
        """Number of posts, mean length and, per term, the number of posts that hold it; replaced posts do not count."""
        summed = self._table("figures", "n long, words long").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).first()
        dead = self._dead()
        gone = dead.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("words")).first()
        n = (summed["n"] or 0) - gone["n"]
        seen = {r["term"]: r["n"] for r in self.postings(terms).groupBy("term").agg(F.sum("n").alias("n")).collect()}
        if gone["n"]:
            # Only blocks that hold a replaced post are opened for this.
            hurt = dead.select(F.col("of").alias("segment"), "block").distinct()
            opened = self.postings(terms).join(hurt, _BLOCK, "left_semi").select("term", "segment", F.explode("posts.key").alias("key"))
            lost = opened.join(dead.select("key", F.col("of").alias("segment")), ["key", "segment"], "left_semi")
            for r in lost.groupBy("term").count().collect():
                seen[r["term"]] -= r["count"]
        return n, ((summed["words"] or 0) - gone["words"]) / n if n else 0.0, seen

    def _weights(self, terms, k1: float, b: float):
        """``weight(i, tf, length)`` of the i-th term as a column."""
        n, mean, seen = self._figures(terms)

        def weight(i: int, tf: Column, length: Column) -> Column:
            df = F.lit(float(seen.get(terms[i], 0)))
            idf = F.log(F.lit(1.0) + (F.lit(float(n)) - df + F.lit(0.5)) / (df + F.lit(0.5)))
            tf = tf.cast("double")
            norm = F.lit(k1) * (F.lit(1 - b) + F.lit(b) * length / F.lit(mean))
            return idf * tf * F.lit(k1 + 1) / (tf + norm)

        return weight

    @staticmethod
    def _total(terms: Sequence[str], weight, tf: str, length: str) -> Column:
        """The weights of all terms, added in their order, so that sums do not depend on the order of rows."""
        each = [F.max(F.when(F.col("term") == t, weight(i, F.col(tf), F.col(length)))) for i, t in enumerate(terms)]
        return reduce(lambda x, y: x + y, [F.coalesce(e, F.lit(0.0)) for e in each], F.lit(0.0))

    def _scored(self, blocks: DataFrame | None, terms, weight) -> DataFrame:
        """(key, relevance) of the posts of the chosen blocks (None: all) that hold a term."""
        rows = self.postings(terms)
        if blocks is not None:
            rows = rows.join(blocks.select(*_BLOCK), _BLOCK, "left_semi")
        posts = rows.select("term", "segment", F.explode("posts").alias("p")).select("term", "segment", "p.*")
        dead = self._dead().select("key", F.col("of").alias("segment"))
        alive = posts.join(dead, ["key", "segment"], "left_anti")
        return alive.groupBy("key").agg(self._total(terms, weight, "tf", "length").alias(RELEVANCE))

    def bounds(self, terms: Sequence[str], weight) -> DataFrame:
        """(segment, block, bound): no post of the block can have a greater relevance.

        A weight grows with the term count and falls with the length.
        """
        bound = self._total(terms, weight, "max_tf", "min_length")
        # A little more than the sum, so that rounding cannot put a post above its bound.
        return self.postings(terms).groupBy(*_BLOCK).agg((bound * F.lit(1 + 1e-9)).alias("bound"))

    def candidate_blocks(self, terms: Sequence[str], weight, limit: int) -> DataFrame:
        """The blocks that may hold one of the ``limit`` best posts.

        The blocks with the greatest bounds are scored first; a block whose
        bound lies below the last of the best posts found there is skipped.
        """
        bounds = self.bounds(terms, weight)
        first = bounds.orderBy(F.desc("bound"), *_BLOCK).limit(limit)
        best = self._scored(first, terms, weight).orderBy(F.desc(RELEVANCE)).limit(limit)
        found = best.agg(F.count("*").alias("n"), F.min(RELEVANCE).alias("least")).first()
        return bounds if found["n"] < limit else bounds.where(F.col("bound") >= F.lit(found["least"]))

    def bm25(self, query: str, limit: int | None = None, k1: float = 1.2, b: float = 0.75) -> DataFrame:
        """(key, relevance) of the posts that hold a term of the query; with a limit, at least the best ones."""
        terms = query_terms(self.spark, query, self.options)
        if not terms or not self._segments():
            kind = self._table("posts", "key string, block long, length int").schema["key"].dataType.simpleString()
            return self.spark.createDataFrame([], f"`{self.key}` {kind}, {RELEVANCE} double")
        weight = self._weights(terms, k1, b)
        blocks = None if limit is None else self.candidate_blocks(terms, weight, limit)
        return self._scored(blocks, terms, weight).withColumnRenamed("key", self.key)

    def search(
        self,
        posts: DataFrame,
        query: str,
        limit: int | None = 100,
        sort_by: str = "relevance",
        time_filter: str = "all",
        as_of: dt.datetime | None = None,
        created: str = "created_utc",
        comments: str = "num_comments",
        **columns,
    ) -> DataFrame:
        """The first ``limit`` of the matching ``posts`` in the chosen order, as ``operators.search.search`` returns them.

        ``posts`` is the table that was indexed; only its matching rows are
        used, and their texts are not tokenised.  Corpus figures are those of
        the whole index also where a time window is asked for.
        """
        if sort_by not in SEARCH_ORDERS:
            raise ValueError(f"sort_by cannot be {sort_by!r}; choose from {', '.join(SEARCH_ORDERS)}")
        by_relevance = sort_by == "relevance"
        best = limit is not None and by_relevance and time_filter == "all"
        found = self.bm25(query, limit if best else None)
        if best:  # so few that Spark sends them to the posts
            found = cut_lineage(top_rows(found, F.col(RELEVANCE), self.key, limit).drop("rank_value"))
        matches = within(posts, time_filter, as_of, created).join(found, self.key)
        if by_relevance:
            rank = F.col(RELEVANCE)
        elif sort_by == "comments":
            rank = F.col(comments)
        else:
            rank = post_rank(matches, sort_by, as_of, created=created, **columns)
        return top_rows(matches, rank, self.key, limit)
