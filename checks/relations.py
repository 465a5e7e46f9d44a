"""Joins, unions and trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.operators import relate, sets
from threadloom.operators.rank import comment_order
from threadloom.operators.tour import is_above, subtree_measures
from threadloom.operators.tree import roots, walk
from threadloom.plans.prepare import prepare_for_ml
from threadloom.sources.normalize import normalize_comments

from .registry import RAW_COMMENTS_SQL, RAW_POSTS_SQL, check, load, raw_comments, raw_posts
from .rows import STORED_COMMENTS_SQL

ITEMS = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]


@check(
    "posts_with_comments",
    """SELECT o.*, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity
       FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey""",
)
def posts_with_comments(spark, folder):
    items = load(spark, folder, "lineitem").select(*ITEMS)
    return relate.with_children(load(spark, folder, "orders"), items, "o_orderkey", "l_orderkey")


@check(
    "posts_with_comments_left",
    f"""WITH {RAW_POSTS_SQL}, {RAW_COMMENTS_SQL}
       SELECT p.id, p.subreddit, c.id AS comment_id, c.post_id, c.subreddit AS comment_subreddit, c.body
       FROM raw_posts p LEFT JOIN raw_comments c ON p.id = c.post_id""",
)
def posts_with_comments_left(spark, folder):
    posts = raw_posts(spark, folder).select("id", "subreddit")
    comments = raw_comments(spark, folder).select("id", "post_id", "subreddit", "body")
    return relate.with_children(posts, comments, how="left")


@check(
    "comment_collection",
    """SELECT o.o_orderkey, CAST(0 AS BIGINT) AS chunk, CAST(count(l.l_orderkey) AS BIGINT) AS n_items,
       coalesce(string_agg(l.l_linenumber || ':' || l.l_partkey, ' '
         ORDER BY l.l_linenumber, l.l_partkey), '') AS items
       FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY o.o_orderkey""",
)
def comment_collection(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey")
    fields = ["l_linenumber", "l_partkey"]
    grouped = relate.collections(
        orders, load(spark, folder, "lineitem"), fields, "o_orderkey", "l_orderkey", "items"
    )
    shown = F.transform("items", lambda x: F.concat_ws(":", x["l_linenumber"], x["l_partkey"]))
    return grouped.select(
        "o_orderkey", "chunk", F.size("items").cast("long").alias("n_items"), F.array_join(shown, " ").alias("items")
    )


@check(
    "comment_collection_chunks",
    """WITH numbered AS (
         SELECT l_suppkey, l_returnflag, l_quantity, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_returnflag, l_quantity) - 1 AS n
         FROM lineitem WHERE l_suppkey % 7 > 0)
       SELECT s_suppkey, coalesce(n // 50, 0) AS chunk, count(l_suppkey) AS n_items,
         coalesce(string_agg(l_returnflag || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), ' ' ORDER BY n), '') AS items
       FROM supplier LEFT JOIN numbered ON s_suppkey = l_suppkey GROUP BY ALL""",
)
def comment_collection_chunks(spark, folder):
    """Parents with several ordered chunks whose items repeat, and parents without any."""
    items = load(spark, folder, "lineitem").where("l_suppkey % 7 > 0").selectExpr("l_suppkey", "l_returnflag", "CAST(l_quantity AS INT) AS quantity")
    suppliers = load(spark, folder, "supplier").select("s_suppkey")
    grouped = relate.collections(suppliers, items, ["l_returnflag", "quantity"], "s_suppkey", "l_suppkey", "items", 50)
    shown = F.transform("items", lambda x: F.concat(x["l_returnflag"], x["quantity"]))
    return grouped.select("s_suppkey", "chunk", F.size("items").cast("long").alias("n_items"), F.array_join(shown, " ").alias("items"))


@check(
    "comment_parent",
    f"""WITH {RAW_POSTS_SQL}, {RAW_COMMENTS_SQL}
       SELECT c.id, c.post_id, p.title, p.subreddit AS post_subreddit, c.subreddit
       FROM raw_comments c LEFT JOIN raw_posts p ON c.post_id = p.id""",
)
def comment_parent(spark, folder):
    comments = raw_comments(spark, folder).select("id", "post_id", "subreddit")
    return relate.with_parent(comments, raw_posts(spark, folder).select("id", "title", "subreddit"))


@check(
    "known_keys",
    """SELECT doc_id, lang, TRUE AS labelled FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
       UNION ALL
       SELECT doc_id, lang, FALSE FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def known_keys(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "lang")
    labels = load(spark, folder, "labels")
    yes = relate.known(docs, labels, "doc_id").withColumn("labelled", F.lit(True))
    return yes.unionByName(relate.unknown(docs, labels, "doc_id").withColumn("labelled", F.lit(False)))


@check("orphans", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def orphans(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "source")
    return relate.orphans(docs, load(spark, folder, "labels"), "doc_id", "doc_id")


@check(
    "comment_counts",
    f"""WITH {RAW_POSTS_SQL}, {RAW_COMMENTS_SQL}
       SELECT p.id, CAST(count(c.id) AS BIGINT) AS comment_count
       FROM raw_posts p LEFT JOIN raw_comments c ON p.id = c.post_id GROUP BY p.id""",
)
def comment_counts(spark, folder):
    return relate.child_counts(raw_posts(spark, folder).select("id"), raw_comments(spark, folder))


CORPUS_SQL = """SELECT 'post' AS kind, CAST(doc_id AS VARCHAR) AS id, text FROM documents
    UNION ALL SELECT 'comment', conv_id || '-' || turn, text FROM conversations"""


@check("corpus_union", CORPUS_SQL)
def corpus_union(spark, folder):
    turns = load(spark, folder, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("id"), "text")
    return sets.corpus(
        ("post", load(spark, folder, "documents"), "doc_id", "text"), ("comment", turns, "id", "text")
    )


@check(
    "prepare_texts",
    f"""WITH {RAW_POSTS_SQL}, {RAW_COMMENTS_SQL}
       SELECT 'post' AS kind, id, coalesce(author, '') AS text FROM raw_posts
       UNION ALL SELECT 'comment', id, coalesce(author, '') FROM raw_comments""",
)
def prepare_texts(spark, folder):
    """The author columns have nulls, which must become empty text."""
    posts, comments = raw_posts(spark, folder), raw_comments(spark, folder)
    return prepare_for_ml(posts, comments, "author", "author").all_texts


@check(
    "concat_columns",
    """SELECT doc_id, lang, NULL AS quality FROM documents
       UNION ALL SELECT doc_id, NULL, quality FROM labels""",
)
def concat_columns(spark, folder):
    return sets.concat(
        load(spark, folder, "documents").select("doc_id", "lang"),
        load(spark, folder, "labels").select("doc_id", "quality"),
    )


TREE_SQL = f"""WITH RECURSIVE {RAW_COMMENTS_SQL}, {STORED_COMMENTS_SQL},
    tree AS (
      SELECT post_id, id, id AS root_id, CAST(0 AS BIGINT) AS walk_depth
      FROM stored_comments WHERE parent_id = post_id
      UNION ALL
      SELECT c.post_id, c.id, t.root_id, t.walk_depth + 1
      FROM stored_comments c JOIN tree t ON c.parent_id = t.id AND c.post_id = t.post_id)"""


@check("comment_tree", f"{TREE_SQL} SELECT * FROM tree")
def comment_tree(spark, folder):
    comments = normalize_comments(raw_comments(spark, folder)).select("post_id", "id", "parent_id")
    return walk(comments).select("post_id", "id", "root_id", "walk_depth")


@check(
    "comment_tree_order",
    f"""WITH RECURSIVE {RAW_COMMENTS_SQL}, {STORED_COMMENTS_SQL},
    tree AS (
      SELECT post_id, id, score::VARCHAR || '/' || id AS path
      FROM stored_comments WHERE parent_id = post_id
      UNION ALL
      SELECT c.post_id, c.id, t.path || ' ' || c.score::VARCHAR || '/' || c.id
      FROM stored_comments c JOIN tree t ON c.parent_id = t.id AND c.post_id = t.post_id)
    SELECT * FROM tree""",
)
def comment_tree_order(spark, folder):
    comments = normalize_comments(raw_comments(spark, folder)).select("post_id", "id", "parent_id", "score")
    shown = F.transform("walk_path", lambda x: F.concat_ws("/", x["score"].cast("string"), x["id"]))
    return walk(comments, sibling_order="score").select("post_id", "id", F.array_join(shown, " ").alias("path"))


def walk_sql(order: str) -> str:
    return f"""WITH RECURSIVE {RAW_COMMENTS_SQL}, {STORED_COMMENTS_SQL},
    numbered AS (SELECT *, row_number() OVER (PARTITION BY post_id, parent_id ORDER BY {order}, id) AS n FROM stored_comments),
    tree AS (
      SELECT post_id, id, 0 AS level, [n] AS path FROM numbered WHERE parent_id = post_id
      UNION ALL
      SELECT c.post_id, c.id, t.level + 1, list_append(t.path, c.n)
      FROM numbered c JOIN tree t ON c.parent_id = t.id AND c.post_id = t.post_id)
    SELECT post_id, id, row_number() OVER (PARTITION BY post_id ORDER BY level, path) AS walk_position FROM tree"""


for _sort, _order in (("top", "score DESC"), ("new", "created_utc DESC"), ("controversial", "abs(score)"), ("qa", "is_submitter DESC, score DESC")):

    @check(f"comment_walk_{_sort}", walk_sql(_order))
    def comment_walk(spark, folder, sort=_sort):
        """Breadth-first numbers under a listing order."""
        comments = normalize_comments(raw_comments(spark, folder))
        return walk(comments, order=comment_order(sort)).select("post_id", "id", "walk_position")


@check(
    "tree_depth_audit",
    f"""{TREE_SQL} SELECT t.id, CAST(t.walk_depth AS BIGINT) AS walk_depth, s."depth" AS stored_depth,
        t.walk_depth = s."depth" AS agrees FROM tree t JOIN stored_comments s ON t.id = s.id""",
)
def tree_depth_audit(spark, folder):
    comments = normalize_comments(raw_comments(spark, folder)).select("post_id", "id", "parent_id", "depth")
    return walk(comments).select(
        "id", "walk_depth", F.col("depth").alias("stored_depth"), (F.col("walk_depth") == F.col("depth")).alias("agrees")
    )


@check(
    "tree_roots",
    f"WITH {RAW_COMMENTS_SQL}, {STORED_COMMENTS_SQL} SELECT id, post_id FROM stored_comments WHERE parent_id = post_id",
)
def tree_roots(spark, folder):
    return roots(normalize_comments(raw_comments(spark, folder))).select("id", "post_id")


@check(
    "comment_subtrees",
    f"""WITH RECURSIVE {RAW_COMMENTS_SQL}, {STORED_COMMENTS_SQL},
    above AS (
      SELECT post_id, id, id AS top, parent_id, score FROM stored_comments
      UNION ALL
      SELECT a.post_id, a.id, c.id, c.parent_id, a.score FROM above a JOIN stored_comments c ON a.parent_id = c.id AND a.post_id = c.post_id)
    SELECT post_id, top AS id, count(*) AS subtree_size, CAST(sum(score) AS BIGINT) AS subtree_score, 2 * count(*) - 1 AS steps FROM above
    WHERE post_id IN (SELECT post_id FROM stored_comments WHERE parent_id = post_id) GROUP BY post_id, top""",
)
def comment_subtrees(spark, folder):
    comments = normalize_comments(raw_comments(spark, folder)).select("post_id", "id", "parent_id", "score")
    measured = subtree_measures(walk(comments))
    return measured.select("post_id", "id", "subtree_size", "subtree_score", (F.col("leave") - F.col("enter")).alias("steps"))


@check(
    "comment_ancestors",
    f"""WITH RECURSIVE {RAW_COMMENTS_SQL}, {STORED_COMMENTS_SQL},
    above AS (
      SELECT post_id, id, parent_id FROM stored_comments
      UNION ALL
      SELECT a.post_id, a.id, c.parent_id FROM above a JOIN stored_comments c ON a.parent_id = c.id AND a.post_id = c.post_id)
    SELECT post_id, id, parent_id AS above_id FROM above WHERE parent_id <> post_id""",
)
def comment_ancestors(spark, folder):
    """Every comment with every comment above it, by a range join on the tour."""
    comments = normalize_comments(raw_comments(spark, folder)).select("post_id", "id", "parent_id", "score")
    measured = subtree_measures(walk(comments)).select("post_id", "id", "enter", "leave")
    joined = measured.alias("a").join(measured.alias("b"), is_above("a", "b"))
    return joined.select("b.post_id", "b.id", F.col("a.id").alias("above_id"))
