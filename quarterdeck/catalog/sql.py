"""Shared SQL for the checks: the input shapes as common table expressions."""

from __future__ import annotations

from quarterdeck.plans import shapes


def qend(c: str) -> str:
    return f"cast(last_day(cast(date_trunc('quarter', {c}) as date) + interval 2 month) as date)"


def _panel_q() -> str:
    measures = ", ".join(f"{e} as {n}" for n, e in shapes.LINE_MEASURES.items())
    fields = {**shapes.STOCK_FIELDS, **shapes.FLOW_FIELDS}
    sums = ",\n".join(f"cast(sum({m}) filter (where {p}) as double) as {n}" for n, (m, p) in fields.items())
    return f"""select CERT, REPDTE, {sums}
from (select l_suppkey as CERT, {qend('l_shipdate')} as REPDTE, l_linenumber, l_returnflag, l_linestatus,
      l_quantity, {measures} from lineitem) group by CERT, REPDTE"""


def _panel() -> str:
    stocks = ", ".join(shapes.STOCK_FIELDS)
    flows = ", ".join(f"sum({c}) over y as {c}" for c in shapes.FLOW_FIELDS)
    return f"select CERT, REPDTE, {stocks}, {flows} from panel_q window y as (partition by CERT, year(REPDTE) order by REPDTE)"


def _fields(fields: dict[str, str], source: str) -> str:
    return "select " + ", ".join(f"{e} as {n}" for n, e in fields.items()) + f" from {source}"


ORDERS = "orders join customer on o_custkey = c_custkey"

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "panel_q": ((), _panel_q()),
    "panel": (("panel_q",), _panel()),
    "bridge": (
        (),
        """select r_name as group_key, s_suppkey as CERT, cast(r_regionkey + 1 as integer) as display_order, r_regionkey in (1, 3) as use_normalized
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
union all select 'ALL', s_suppkey, 6, false from supplier""",
    ),
    "series": (
        (),
        f"select l_suppkey as SeriesID, cast(l_shipdate as date) as DATE, cast(sum({shapes.LINE_MEASURES['v']}) as double) as VALUE from lineitem group by 1, 2",
    ),
    "extract": ((), _fields(shapes.LOAN_FIELDS, ORDERS)),
    "credit": ((), _fields(shapes.CREDIT_LOOKUP_FIELDS, "customer")),
    "reserve": ((), _fields(shapes.RESERVE_LOOKUP_FIELDS, "orders")),
    "property": ((), _fields(shapes.PROPERTY_LOOKUP_FIELDS, "part")),
    "deals": ((), _fields(shapes.TRACKER_FIELDS, ORDERS)),
}


def register(name: str, body: str, needs: tuple[str, ...] = ()) -> None:
    CTES[name] = (needs, body)


def with_ctes(body: str, *needs: str, recursive: bool = False) -> str:
    """Prefix a SELECT with the named shapes and whatever they need."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][0]:
            visit(dep)
        order.append(name)

    for name in needs:
        visit(name)
    head = ",\n".join(f"{n} as ({CTES[n][1]})" for n in order)
    return f"with {'recursive ' if recursive else ''}{head}\n{body}"
