"""Named entities by gazetteer and pattern, in order of occurrence; and a hook for a model."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from emberlink import schemas

Tagger = Callable[[Sequence[str]], Sequence[Sequence[tuple[str, str]]]]

# Names the tagger knows, by label; a user's own take their place.
GAZETTEER = {
    "LOC": [
        "Germany", "Deutschland", "Switzerland", "Schweiz", "Blatten", "Wallis", "Valais", "Bern",
        "Europe", "Alps", "Schwarzwald", "Bayern", "Brandenburg", "Niedersachsen", "Sachsen",
        "Thüringen", "Mecklenburg", "Hessen", "Pfalz", "Saarland", "Hamburg", "Berlin", "Bremen",
    ],
    "ORG": ["Feuerwehr", "Polizei", "Bundeswehr", "NASA", "GDACS", "ReliefWeb"],
}

_NO_LETTER_BEFORE = r"(?<![\p{L}\p{N}])"
_NO_LETTER_AFTER = r"(?![\p{L}\p{N}])"


def entities(
    text: str | Column,
    gazetteer: Mapping[str, Sequence[str]] = GAZETTEER,
    patterns: Mapping[str, str] | None = None,
) -> Column:
    """``array<struct<text,label>>`` of whole-word names, then patterns where no name matches.

    All names and patterns are one regular expression, so the text is read once. Longer names
    come first: "Central Europe" wins over "Europe".
    """
    text = F.col(text) if isinstance(text, str) else text
    label_of = {name: label for label, names in gazetteer.items() for name in names}
    names = sorted(label_of, key=lambda n: (-len(n), n))
    choices = [re.escape(n).replace("\\ ", " ") for n in names]
    choices += [f"(?:{p})" for p in (patterns or {}).values()]
    expression = f"{_NO_LETTER_BEFORE}(?:{'|'.join(choices)}){_NO_LETTER_AFTER}"

    def labelled(found: Column) -> Column:
        label = F.coalesce(
            *[F.when(found.isin(*names), F.lit(kind)) for kind, names in gazetteer.items()],
            *[F.when(found.rlike(f"^(?:{p})$"), F.lit(kind)) for kind, p in (patterns or {}).items()],
        )
        return F.struct(found.alias("text"), label.alias("label"))

    return F.transform(F.regexp_extract_all(text, F.lit(expression), F.lit(0)), labelled)


def extract_entities(
    df: DataFrame,
    text: str | Column,
    gazetteer: Mapping[str, Sequence[str]] = GAZETTEER,
    patterns: Mapping[str, str] | None = None,
    make_tagger: Callable[[], Tagger] | None = None,
    linked: str = "linked_fire_id",
    override: bool = False,
) -> DataFrame:
    """Fill ``entities`` of linked articles that have none yet; other rows stay as they are.

    ``make_tagger`` loads a model once per task and takes the place of the gazetteer.
    """
    text = F.col(text) if isinstance(text, str) else text
    due = F.col(linked).isNotNull()
    if not override:
        due = due & F.col("entities").isNull()
    if make_tagger is None:
        tagged = entities(F.coalesce(text, F.lit("")), gazetteer, patterns)
    else:

        @F.pandas_udf(T.ArrayType(schemas.ENTITY))
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            tagger = make_tagger()
            for texts in batches:
                # Rows that are not due come as null, and the tagger does not see them.
                wanted = texts.notna()
                found = iter(tagger(texts[wanted].tolist()) if wanted.any() else [])
                yield pd.Series(
                    [[{"text": t, "label": k} for t, k in next(found)] if due else None for due in wanted], dtype=object
                )

        tagged = run(F.when(due, F.coalesce(text, F.lit(""))))
    return df.withColumn("entities", F.when(due, tagged).otherwise(F.col("entities")))
