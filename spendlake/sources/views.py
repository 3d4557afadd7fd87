"""The driver's tables seen as the domain's tables.

Each view is one SQL text that Spark and DuckDB both accept, so a query and the
statement that checks it start from the same rows. Ids come from the smallest
part key of a group: a stable id that needs a map-side combined aggregate only,
where a global ``dense_rank`` would sort everything in one task.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_SCHEMAS: dict[tuple[str, str], StructType] = {}

# name -> (inputs, statement); inputs come before the views that use them.
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "users": (("customer",), "select c_custkey as user_seq, c_name as user_id from customer"),
    "agg_group": (
        ("region",),
        "select cast(r_regionkey as bigint) as agg_group_seq, r_name as agg_group_name, "
        "r_regionkey <> 4 as is_active from region",
    ),
    "telegram_room": (
        ("nation",),
        "select cast(n_nationkey as bigint) as room_seq, n_nationkey % 6 <> 0 as is_room_approved, "
        "cast(n_regionkey as bigint) as agg_group_seq from nation",
    ),
    "user_payment_methods": (
        ("supplier",),
        "select s_suppkey as payment_method_id, s_name as card_alias from supplier",
    ),
    "send_email_agg_group": (
        ("customer", "nation"),
        "select cast(n.n_regionkey as bigint) as agg_group_seq, "
        "lower(replace(c.c_name, '#', '.')) || '@example.com' as email_id, c.c_acctbal >= 0 as is_active "
        "from customer c join nation n on c.c_nationkey = n.n_nationkey",
    ),
    "keyword_type": (
        ("part",),
        "select min(p_partkey) as consume_keyword_type_id, p_type as consume_keyword_type from part group by p_type",
    ),
    "prodt_keyword": (
        ("part", "keyword_type"),
        "select k.consume_keyword_id, k.consume_keyword, cast(1 + k.n % 3 as int) as keyword_weight, "
        "t.consume_keyword_type_id from (select min(p_partkey) as consume_keyword_id, p_name as consume_keyword, "
        "min(p_type) as p_type, count(*) as n from part group by p_name) k "
        "join keyword_type t on k.p_type = t.consume_keyword_type",
    ),
    "spent_detail": (
        ("orders", "customer", "part", "supplier", "keyword_type"),
        "select o.o_orderkey as spent_idx, p.p_name as spent_name, "
        "cast(round(o.o_totalprice) as bigint) * (case when o.o_orderkey % 50 = 0 then -1 else 1 end) as spent_money, "
        "o.o_orderdate as spent_at, o.o_orderdate as created_at, o.o_orderstatus <> 'F' as should_index, "
        "o.o_custkey as user_seq, t.consume_keyword_type_id, cast(c.c_nationkey as bigint) as room_seq, "
        "o.o_orderkey % (select count(*) from supplier) as payment_method_id "
        "from orders o join customer c on o.o_custkey = c.c_custkey "
        "join part p on p.p_partkey = o.o_orderkey % (select count(*) from part) "
        "join keyword_type t on t.consume_keyword_type = p.p_type",
    ),
    "cdc_event": (
        ("events",),
        "select event_id as msg_offset, cast(event_id % 3 as int) as partition_id, "
        "cast((event_id - event_id % 3) / 3 as bigint) as partition_offset, user_id as spent_idx, "
        "case event_type when 'signup' then 'I' when 'error' then 'delete' when 'click' then 'update' else 'U' end "
        "as indexing_type, ts as reg_at from events",
    ),
    "group_offset": (
        ("events",),
        "select 'ref' as group_name, cast(event_id % 3 as int) as partition_id, count(*) as committed_offset "
        "from events where ts < timestamp '2024-01-25 00:00:00' group by event_id % 3 union all "
        "select 'catchup' as group_name, cast(1 + event_id % 3 as int) as partition_id, "
        "count(*) as committed_offset from events where ts < timestamp '2024-01-20 00:00:00' group by event_id % 3",
    ),
    "stock_type": (
        ("part",),
        "select min(p_partkey) as market_seq, p_brand as market_alias, "
        "case min(p_partkey) % 3 when 0 then 'KRW' when 1 then 'USD' else 'JPY' end as currency_code "
        "from part group by p_brand",
    ),
    "currency_code": (("stock_type",), "select distinct currency_code from stock_type"),
    "currency_exchange_rate_snapshot": (
        ("supplier",),
        "select s_suppkey as exchange_rate_snapshot_seq, "
        "case s_suppkey % 4 when 0 then 'USD' when 1 then 'JPY' when 2 then 'EUR' else 'CNY' end "
        "as base_currency_code, 'KRW' as target_currency_code, "
        "cast(abs(s_acctbal) as decimal(18,8)) as exchange_rate, s_acctbal >= 0 as is_active from supplier",
    ),
    "holiday": (
        ("orders",),
        "select distinct cast(o_orderdate as date) as dt from orders where "
        "(extract(month from o_orderdate) in (1, 3) and extract(day from o_orderdate) = 1) or "
        "(extract(month from o_orderdate) = 5 and extract(day from o_orderdate) = 5) or "
        "(extract(month from o_orderdate) = 12 and extract(day from o_orderdate) = 25)",
    ),
    "stock": (
        ("part", "stock_type"),
        "select p.p_partkey as stock_seq, m.market_seq, p.p_name as stock_name, "
        "'S' || cast(p.p_partkey as varchar(20)) as api_symbol, "
        "case when p.p_partkey % 97 = 0 then null else cast(p.p_retailprice as decimal(18,4)) end as stock_price "
        "from part p join stock_type m on p.p_brand = m.market_alias",
    ),
    "stock_asset": (
        ("lineitem", "orders"),
        "select o.o_custkey as user_seq, l.l_partkey as stock_seq, cast(l.l_quantity as bigint) as stock_cnt "
        "from lineitem l join orders o on l.l_orderkey = o.o_orderkey",
    ),
    "crypto": (
        ("supplier",),
        "select s_suppkey as crypto_seq, s_name as crypto_name, 'C' || cast(s_suppkey as varchar(20)) as api_symbol, "
        "cast(abs(s_acctbal) as decimal(18,4)) as crypto_price, "
        "case when s_suppkey % 7 = 0 then 'EUR' when s_suppkey % 2 = 0 then 'USD' else 'KRW' end as currency_code "
        "from supplier",
    ),
    "crypto_asset": (
        ("lineitem", "orders"),
        "select o.o_custkey as user_seq, l.l_suppkey as crypto_seq, cast(l.l_discount as decimal(18,8)) as crypto_cnt "
        "from lineitem l join orders o on l.l_orderkey = o.o_orderkey where l.l_discount > 0",
    ),
    "cash_asset": (
        ("customer",),
        "select c_custkey as user_seq, cast(c_acctbal as decimal(18,4)) as cash, "
        "case c_nationkey % 3 when 0 then 'KRW' when 1 then 'USD' else 'EUR' end as currency_code from customer",
    ),
    "deposit_asset": (
        ("orders",),
        "select o_custkey as user_seq, cast(o_totalprice as decimal(18,4)) as deposit_amount, "
        "case when o_orderkey % 2 = 0 then 'KRW' else 'USD' end as currency_code, "
        "o_orderstatus = 'F' as is_terminated from orders where o_orderpriority = '1-URGENT'",
    ),
    "saving_asset": (
        ("orders",),
        "select o_custkey as user_seq, cast(o_totalprice as decimal(18,4)) as accum_saving_amount, "
        "case when o_orderkey % 2 = 0 then 'KRW' else 'JPY' end as currency_code, "
        "o_orderstatus = 'F' as is_terminated from orders where o_orderpriority = '2-HIGH'",
    ),
}


def _closure(names: tuple[str, ...]) -> set[str]:
    found: set[str] = set()
    pending = list(names)
    while pending:
        name = pending.pop()
        if name not in found:
            found.add(name)
            pending.extend(VIEWS[name][0] if name in VIEWS else ())
    return found


def with_views(*names: str) -> str:
    """``name as (...), ...`` for the views and everything they are built from."""
    wanted = _closure(names)
    return ", ".join(f"{name} as ({sql})" for name, (_, sql) in VIEWS.items() if name in wanted)


class Domain:
    """Domain tables over a folder of the driver's parquet tables.

    Frames are kept, so a folder is listed once per instance; make a new instance to
    see files that came later. Schemas are read from the files once per session.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._frames: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._read(name) if name in BASE_TABLES else self._view(name)
        return self._frames[name]

    def _read(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        known = (self.spark.sparkContext.applicationId, path)
        if known not in _SCHEMAS:
            _SCHEMAS[known] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[known]).parquet(path)

    def _view(self, name: str) -> DataFrame:
        """The view's statement over its input frames, which stand in it themselves.

        Named by a ``with`` each, they would nest as views do, and Spark can take a name of an inner
        ``with`` for one of an outer.
        """
        inputs, statement = VIEWS[name]
        sql = re.sub(rf"\b(from|join) ({'|'.join(inputs)})\b", r"\1 {\2}", statement)
        return self.spark.sql(sql, **{source: self.table(source) for source in inputs})

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS or name in BASE_TABLES:
            return self.table(name)
        raise AttributeError(name)
