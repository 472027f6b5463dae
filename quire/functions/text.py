"""Column functions over work records: text, identifiers, links and concepts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
#: White space as the corpus counts it: U+0009..U+000D, U+001C..U+0020, U+0085, U+00A0, U+1680,
#: U+2000..U+200A, U+2028, U+2029, U+202F, U+205F and U+3000.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
#: Concept every work must carry to enter the corpus unless another one is asked for.
DEFAULT_CONCEPT = "C71924100"
#: Text modes of :func:`build_text`.
TEXT_MODES = ("title", "abstract", "title_abstract")
#: Short form of a work identifier.
SHORT_ID = r"(?U)^W\d+$"
# ----------------------------------------------------------------------------


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable.

    An array expression named inside a lambda is otherwise recomputed per element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def non_empty(c: Column) -> Column:
    """Null for the empty string."""
    return F.nullif(c, F.lit(""))


def strip(c: Column) -> Column:
    """Remove white space from both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def squeeze(c: Column) -> Column:
    """Turn each run of white space into one space and strip the ends."""
    return F.trim(F.regexp_replace(c, f"[{WHITESPACE}]++", " "))


def placed_tokens(index: Column) -> Column:
    """Sorted ``array<bigint>``: position in the upper half, number of the map entry in the lower.

    Plain numbers sort without comparing structs. Negative positions are left out.
    """

    def place(positions, entry):
        kept = F.filter(
            F.coalesce(positions, F.array().cast("array<int>")), lambda p: p.isNotNull() & (p >= 0)
        )
        return F.transform(
            kept, lambda p: F.shiftleft(p.cast("bigint"), 32).bitwiseOR(entry.cast("bigint"))
        )

    return F.sort_array(F.flatten(F.transform(F.map_values(index), place)))


def reconstruct_abstract(index: Column) -> Column:
    """Abstract text of an inverted index ``map<token, positions>``, null when it has none.

    Where tokens share a position the one latest in map order holds it, even when it is
    the empty token; gaps are skipped and white space is squeezed.
    """

    def tokens(source):
        placed = F.transform(_last_slots(source["slots"]), lambda slot: _token(source["keys"], slot))
        return F.array_join(F.filter(placed, lambda token: token != ""), " ")

    return non_empty(squeeze(let(_keys_and_slots(index), tokens)))


def slot_tokens(index: Column) -> Column:
    """``array<struct<p: bigint, token: string>>``: each position of an inverted index with the token that holds it."""

    def tokens(source):
        return F.transform(
            _last_slots(source["slots"]),
            lambda slot: F.struct(F.shiftright(slot, 32).alias("p"), _token(source["keys"], slot).alias("token")),
        )

    return let(_keys_and_slots(index), tokens)


def _keys_and_slots(index: Column) -> Column:
    return F.struct(F.map_keys(index).alias("keys"), placed_tokens(index).alias("slots"))


def _last_slots(slots: Column) -> Column:
    """Of the placed tokens that share a position the last in map order."""

    def is_last(slot, j):
        following = F.get(slots, j + 1)
        return following.isNull() | (F.shiftright(following, 32) != F.shiftright(slot, 32))

    return F.filter(slots, is_last)


def _token(keys: Column, slot: Column) -> Column:
    return F.get(keys, slot.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))


def max_position(index: Column) -> Column:
    """Highest position in an inverted index."""
    return F.array_max(F.flatten(F.map_values(index)))


def position_count(index: Column) -> Column:
    """Number of positions in an inverted index."""
    return F.size(F.flatten(F.map_values(index)))


def work_title(title: Column, display_name: Column) -> Column:
    """The title, or the display name where the title is missing or empty."""
    return F.coalesce(non_empty(title), display_name)


def check_mode(mode: str) -> str:
    if mode not in TEXT_MODES:
        raise ValueError(f"unknown text mode {mode!r}; choose one of {', '.join(TEXT_MODES)}")
    return mode


def build_text(title: Column, abstract: Column, mode: str = "title_abstract") -> Column:
    """Text to embed, null when the chosen fields hold nothing."""
    check_mode(mode)
    parts = {"title": [title], "abstract": [abstract], "title_abstract": [title, abstract]}[mode]
    # concat_ws leaves nulls out, so one missing side yields the other one alone.
    return non_empty(F.concat_ws("\n\n", *[non_empty(strip(p)) for p in parts]))


def has_concept(concepts: Column, concept_id: str = DEFAULT_CONCEPT) -> Column:
    """True when a concept id equals ``concept_id`` or ends with it as last path segment."""
    return F.coalesce(
        F.exists(
            concepts,
            lambda c: (c["id"] == concept_id) | F.endswith(c["id"], F.lit("/" + concept_id)),
        ),
        F.lit(False),
    )


def short_work_id(work_id: Column) -> Column:
    """``W...`` at the end of an identifier or URL, null for anything else."""
    last = F.substring_index(work_id, "/", -1)
    return F.when(F.rlike(last, F.lit(SHORT_ID)), last)


def best_url(work: str = "") -> Column:
    """First link present, from open access down to the identifier.

    ``work`` names a struct column that holds the record, or nothing for top-level columns.
    """
    at = (lambda name: F.col(f"{work}.{name}")) if work else F.col
    links = [
        "open_access.oa_url",
        "best_oa_location.landing_page_url",
        "best_oa_location.pdf_url",
        "primary_location.landing_page_url",
        "doi",
    ]
    return F.coalesce(*[non_empty(at(link)) for link in links], at("id"))


def part_https(url: Column) -> Column:
    """Public HTTPS form of an ``s3://`` URL; other URLs stay as they are."""
    return F.regexp_replace(
        url, r"(?s)^(?i:s3)://([^/?#]*)/*([^?#]*).*$", "https://$1.s3.amazonaws.com/$2"
    )


def clamp_k(k: Column, default: int = 50, limit: int = 200) -> Column:
    """Number of hits asked for, between 1 and ``limit``."""
    return F.greatest(F.lit(1), F.least(F.coalesce(k, F.lit(default)), F.lit(limit)))
