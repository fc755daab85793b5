"""Table functions."""

from __future__ import annotations

from pyspark.sql.functions import udtf

# The rows (uid, income, expense) that get_detail looks up.
DETAIL_ROWS = (
    (1, 100, 20),
    (1, 200, 50),
    (2, 50, None),
    (3, None, 100),
)


@udtf(returnType="income int, expense int", useArrow=True)
class GetDetail:
    """All records of a user, written as a Python table function."""

    def __init__(self):
        self.records = {}
        for uid, income, expense in DETAIL_ROWS:
            self.records.setdefault(uid, []).append((income, expense))

    def eval(self, uid: int):
        yield from self.records.get(uid, ())
