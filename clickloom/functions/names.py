"""Column-name, label and path expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def snake(text: Column | str) -> Column:
    """Lower case with spaces and hyphens turned into underscores."""
    return F.translate(F.lower(text), " -", "__")


def normalize_name(prefix: str, text: Column | str) -> Column:
    """``prefix`` and the normalised text; null stays null."""
    return F.concat(F.lit(prefix), snake(text))


def item_key(event_type: Column | str, item: Column | str) -> Column:
    """``{event_type}_{item}``; only the item is normalised, a null part makes the key null."""
    return F.concat(event_type, F.lit("_"), snake(item))


def display_name(label: Column | str) -> Column:
    """``ned_flanders`` as ``Ned Flanders``: each part between underscores is capitalised."""
    words = F.transform(
        F.split(label, "_"),
        lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2)))),
    )
    return F.array_join(words, " ")


def file_name(path: Column | str) -> Column:
    """Last part of a path."""
    return F.substring_index(path, "/", -1)


def parent_folder(path: Column | str) -> Column:
    """Name of the folder a file lies in; null when the path has none."""
    parts = F.split(path, "/")
    return F.get(parts, F.size(parts) - 2)
