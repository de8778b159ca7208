"""Title, genre and label expressions, all JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The 19 genre flags of the ML-100K item file, in file order.
GENRES = [
    "unknown", "Action", "Adventure", "Animation", "Children", "Comedy", "Crime",
    "Documentary", "Drama", "Fantasy", "Film-Noir", "Horror", "Musical", "Mystery",
    "Romance", "Sci-Fi", "Thriller", "War", "Western",
]

# Title patterns. (?U) makes \s and \d follow Unicode.
_YEAR_AT_END = r"(?U)\((\d{4})\)\s*$"
_YEAR_SUFFIX = r"(?U)\s*\(\d{4}\)\s*$"
_OUTER_SPACE = r"(?U)^\s+|\s+$"
_ANY_SPACE = r"(?U)\s+"
_TRAILING_ARTICLE = r"(?iU)^(.+),\s+(The|A|An)$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_year(title: Column | str) -> Column:
    """Four-digit year in closing parentheses, or null."""
    return F.regexp_extract(_col(title), _YEAR_AT_END, 1).try_cast("int")


def clean_title(title: Column | str) -> Column:
    """Title without its year, single-spaced, with a trailing article moved to the front."""
    bare = F.regexp_replace(_col(title), _YEAR_SUFFIX, "")
    spaced = F.regexp_replace(F.regexp_replace(bare, _OUTER_SPACE, ""), _ANY_SPACE, " ")
    return F.regexp_replace(spaced, _TRAILING_ARTICLE, "$2 $1")


def genre_array(flags: dict[str, Column | str]) -> Column:
    """Names of the flags that equal 1, in the order of ``flags``; a null flag counts as 0."""
    return F.array_compact(
        F.array(*[F.when(_col(flag) == 1, F.lit(name)) for name, flag in flags.items()])
    )


def genre_onehot(df: DataFrame, names: list[str], genres: Column | str = "genres") -> DataFrame:
    """Item features in wide form: id, title, year, then one 0/1 column per name."""
    g = _col(genres)
    flags = [
        F.coalesce(F.array_contains(g, F.lit(n)), F.lit(False)).cast("int").alias(n) for n in names
    ]
    return df.select("item_id", "title", "year", *flags)


def ts_to_string(seconds: Column | str) -> Column:
    """Unix seconds as ``yyyy-MM-dd HH:mm:ss`` in UTC, whatever the session time zone."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return F.date_format(F.timestamp_add("SECOND", _col(seconds), epoch), "yyyy-MM-dd HH:mm:ss")


def version_string(ts: Column | str) -> Column:
    """Model version label ``vYYYYMMDD_HHMMSS`` of a UTC wall-clock timestamp."""
    return F.concat(F.lit("v"), F.date_format(_col(ts), "yyyyMMdd_HHmmss"))


def sanitize_metric(name: Column | str) -> Column:
    """Metric name as stored by the run table (``@`` becomes ``_at_``)."""
    return F.replace(_col(name), F.lit("@"), F.lit("_at_"))


def request_id() -> Column:
    """A random UUID."""
    return F.uuid()


def json_ids(text: Column | str) -> Column:
    """JSON list of integers as an array; anything else is null."""
    return F.from_json(_col(text), "array<bigint>")


def title_label(title: Column | str, year: Column | str) -> Column:
    """Selection label: ``Title (Year)``, or only the title when the year is unknown."""
    suffix = F.when(_col(year).isNotNull(), F.concat(F.lit(" ("), _col(year), F.lit(")")))
    return F.concat(_col(title), F.coalesce(suffix, F.lit("")))


def genre_label(genres: Column | str) -> Column:
    """Genres joined for display, ``Unknown`` when there are none."""
    joined = F.concat_ws(", ", _col(genres))
    return F.when(joined == "", F.lit("Unknown")).otherwise(joined)


def similarity_percent(score: Column | str) -> Column:
    """Similarity as shown to users: times 100."""
    return _col(score) * 100


def fallback_kind(reason: Column | str) -> Column:
    """Class of a fallback reason: popularity, genre, seed or other; null when absent."""
    r = _col(reason)
    return (
        F.when(r.isNull() | (r == ""), F.lit(None).cast("string"))
        .when(r == "popularity", "popularity")
        .when(r.startswith("popularity:genre="), "genre")
        .when(r.startswith("similar_to_seed:"), "seed")
        .otherwise("other")
    )


def fallback_argument(reason: Column | str) -> Column:
    """Genre or seed id named in a fallback reason, else null."""
    r = _col(reason)
    return F.when(
        r.startswith("popularity:genre="), F.regexp_extract(r, "=([^=]*)", 1)
    ).when(r.startswith("similar_to_seed:"), F.regexp_extract(r, ":([^:]*)", 1))
