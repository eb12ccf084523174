"""Print the executed physical plans of the scale-critical steps (used to
write PLANS.md): run at sf0.1 after the fixture lake exists."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakemart.operators.dedupe import dedupe_latest  # noqa: E402
from lakemart.plans import dq, gold, metrics, silver, star  # noqa: E402
from lakemart.plans.pipeline import fixture_lake  # noqa: E402
from lakemart.session import build_session  # noqa: E402


def show(title: str, df) -> None:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("+- == Initial Plan ==")[0]
    plan = re.sub(r"#\d+L?", "", plan)
    plan = re.sub(r"file:[^\],]*", "…", plan)
    lines = []
    for ln in plan.splitlines():
        short = ln[:150]
        if "FileScan" in ln:
            for tag in ("PartitionFilters", "PushedFilters"):
                m = re.search(tag + r": \[[^\]]*\]", ln)
                if m and m.group(0) != f"{tag}: []":
                    short += "\n" + " " * (len(ln) - len(ln.lstrip()) + 6) + m.group(0)[:150]
        lines.append(short)
    print(f"\n### {title}\n\n```\n" + "\n".join(lines) + "\n```")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[4]")
    st = fixture_lake(spark, sf)
    cfg = silver.SilverConfig(order_cols=("seq",))
    show("Dedupe: partial max(struct) before the shuffle", dedupe_latest(st.bronze["orders"], "order_id", ("seq",)))
    ok = gold.order_keys(st.silver_orders, st.dim_customer, st.dim_store, st.dim_date, st.dim_rows)
    show("Items classification: dedupe + two validation joins carrying the fact keys",
         silver.order_items(st.bronze["order_items"], ok, st.dim_product, cfg, silver.ORDER_CARRY,
                            silver.PRODUCT_CARRY))
    show("Fact: the product is looked up, then one move of the items to their orders",
         gold.fact_sales(gold.keyed_items(st.silver_order_items, ok, st.dim_product, st.dim_rows)))
    show("Dense surrogate key: checkpointed range partitions + bounded offsets", gold.dim_product(st.silver_products))
    show("Revenue by category: aggregate the fact, then join the dimension", metrics.revenue_by_category(st))
    show("Month KPIs: static partition pruning", metrics.month_slice_kpis(st, 1998, 1))
    show("Calendar slice: dynamic partition pruning through dim_date", star.date_slice(st, year=[1998], quarter=[1]))
    show("DQ of one table in one plan (orders)",
         dq.run_all_checks("bronze", dq.bronze_tables(st), only={"Duplicate order_id", "Invalid order_status",
                                                                  "Invalid customer_id FK"}))


if __name__ == "__main__":
    main()
