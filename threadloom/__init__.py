"""Threadloom: cleaning, merging and analysing discussion data on Spark."""

from .functions.sentences import SentenceModel, fit_sentences, sentences
from .functions.text import TextOptions, clean, tokens
from .operators.dedup import keep_last
from .operators.features import comment_features, post_features, top_values
from .operators.filters import by_date, by_equality, by_expr, by_keywords, by_score, having
from .operators.keywords import holds_keyword, keyword_hits
from .operators.metrics import StepMetrics
from .operators.morphology import lemma_table
from .operators.rank import comment_listing, listing
from .operators.relate import (
    child_counts,
    collections,
    known,
    orphans,
    unknown,
    with_children,
    with_parent,
)
from .operators.search import bm25, search
from .operators.sets import concat, corpus
from .operators.tour import is_above, subtree_measures
from .operators.transforms import add_fields, clean_fields
from .operators.tree import roots, walk
from .operators.upsert import append_keep_last, merge_columns, replace_rows
from .operators.vocab import lemmatize
from .plans.clean import clean_comments, clean_posts
from .plans.collect import posts_with_comments
from .plans.prepare import extract_features, prepare_for_analysis, prepare_for_ml
from .plans.run import run
from .session import get_spark, ship, size_shuffles
from .sources.normalize import normalize_comments, normalize_community, normalize_posts
from .sources.files import import_csv, import_json_array
from .sources.search_index import SearchIndex
from .sources.store import Store, create_store, reconcile, reconcile_rows
from .streaming.flow import clean_stream, upsert_stream
from .streaming.state import keep_last_stream, use_state

__all__ = [name for name in dir() if not name.startswith("_")]
