"""One-to-many callbacks over a dialog as a table function.

A user's own expansion of a dialog into records is a Python function from the dialog's turns to records. It runs as a
table function that is given the rows of one dialog after another, in order: Spark deals the dialogs out and sorts them,
and a task holds one dialog at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf


def expand_dialogs(turns: DataFrame, key: str, order: str, schema: str, expand: Callable[[list], Iterable[tuple]], arrow: bool = True) -> DataFrame:
    """``key`` and the columns of ``schema``: what ``expand`` makes of each dialog's rows, which it gets in ``order``.

    A row that ``expand`` yields is a tuple after ``schema``. Rows with a null key are one dialog. Each dialog meets in
    one task, as the callback asks for all of it. Rows travel in Arrow batches.
    """
    made = T.StructType.fromDDL(schema)
    returns = T.StructType([T.StructField(key, turns.schema[key].dataType), *made.fields])

    class Expansion:
        def __init__(self):
            self.rows = []

        def eval(self, row) -> None:
            self.rows.append(row)

        def terminate(self):
            if self.rows:
                for record in expand(self.rows):
                    yield (self.rows[0][key], *record)

    function = udtf(Expansion, returnType=returns, useArrow=arrow)
    return function(turns.asTable().partitionBy(F.col(key)).orderBy(F.col(order)))


def prompts_of_dialog(rows: list) -> Iterable[tuple]:
    """``(pair_idx, query, response, system)`` of a dialog of rows with ``role, text, system_prompt``; see
    :func:`quern.operators.dialog.dialog_pairs` without system turns, whose records these are."""
    roles = [r["role"] for r in rows]
    if len(rows) < 2:
        return
    start = 0 if roles[0] == "human" else 1
    stop = next((i for i in range(2, len(rows)) if roles[i] not in ("human", "gpt")), len(rows))
    if roles[1] not in ("human", "gpt"):
        stop = 1
    kept = [rows[i] for i in range(start, stop) if roles[i] == ("human", "gpt")[(i - start) % 2]]
    if len(rows) - start < 2 or len(kept) % 2:
        return
    own = max((r["system_prompt"] for r in rows if r["system_prompt"] is not None), default=None)
    for i in range(0, len(kept), 2):
        yield i // 2, kept[i]["text"], kept[i + 1]["text"], own if i == 0 else None
