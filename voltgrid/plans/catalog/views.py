"""Domain views for the checks, in the same words as the Spark bindings."""

from .. import bindings as b
from ..registry import view

view("reg", b.REGISTRATIONS.format(text="VARCHAR"))
view("od", b.OD_ROUTES.format(text="VARCHAR"))
view("sites", b.SITES.format(text="VARCHAR"))
view("subs", b.SUBSTATIONS.format(text="VARCHAR"))
view("roads", b.ROADS.format(text="VARCHAR"))
view("urban", b.URBAN.format(text="VARCHAR"))


def values(rows, columns) -> str:
    def one(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return f"CAST({v!r} AS DOUBLE)" if isinstance(v, float) else repr(v)

    listed = ", ".join("(" + ", ".join(one(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {listed}) AS t({', '.join(columns)})"
