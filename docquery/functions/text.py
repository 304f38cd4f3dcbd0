"""Full text: whole words of all strings and numbers under a path, whatever their case."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What separates words.
BREAK = r"[^\p{L}\p{N}_]+"


def contains(items: Column, words: str) -> Column:
    """Whether all given words stand among the values (not the keys) of some items.

    The items' JSON texts are split into words once their escapes and keys are cut out, so depth
    needs no recursion: escaped line breaks, tabs and quotes separate words as the characters do.
    """
    texts = F.transform(items, lambda x: F.regexp_replace(F.to_json(x), r"\\(u[0-9a-fA-F]{4}|.)", " "))
    bare = F.transform(texts, lambda t: F.regexp_replace(t, r'"[^"]*":', " "))
    clean = F.lower(F.array_join(bare, " "))
    tokens = F.split(clean, BREAK)
    wanted = [w for w in re.split(r"\W+", words.lower()) if w]
    return F.coalesce(F.size(F.array_intersect(tokens, F.array(*map(F.lit, wanted)))) == len(set(wanted)), F.lit(False)) if wanted else F.lit(False)
