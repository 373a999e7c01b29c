import datetime as dt

import pytest
from pyspark.sql import functions as F

from clientele.operators import ingest as I
from clientele.operators.calendar import dim_date
from clientele.plans import ingest_job
from clientele.plans.ingest_job import FACTS, REJECTS, TABLES, load_feed, warehouse_table
from clientele.session import scratch_folder
from clientele.sources import schemas as S

CSV = """Transaction ID,Date,Customer ID,Product Category,Quantity,Price per Unit,Total Amount,Gender
1,2023-01-05,7,Beauty,2,50,100,F
2,not a date,7,Beauty,1,50,50,F
3,2019-06-01,8,Beauty,1,50,50,M
4,2023-02-01,8,Home Goods,0,30,0,M
5,2023-02-02,9,Clothing,x,30,30,F
6,2023-02-03,9,home goods,3,10,30,F
7,2023-02-04,7,Clothing,1,25.5,25.5,F
8,2023-02-05,7,Beauty,2.0,50,100,F
9,2023-02-06,7,Beauty,1,50,oops,F
"""


def _empty(spark, schema, cols):
    return spark.createDataFrame([], schema).select(*cols)


def test_csv_load_end_to_end(spark, tmp_path):
    path = tmp_path / "tx.csv"
    path.write_text(CSV)
    raw = I.read_transactions(spark, str(path))
    assert raw.columns == I.RAW_COLUMNS  # extra column dropped
    tx = I.ingest_transform(raw)
    rows = {r.OrderID: r for r in tx.collect()}
    assert rows["ORD_2"].OrderDate is None and rows["ORD_5"].Quantity is None
    assert rows["ORD_4"].ProductID == "PROD_HOME_GOODS" and rows["ORD_6"].ProductID == "PROD_HOME_GOODS"
    assert rows["ORD_1"].Email == "cust_7@example.com" and rows["ORD_7"].SalesAmount == 25.5

    regions = I.region_rows(_empty(spark, S.DIM_REGION, ["RegionKey", "RegionID", "RegionName",
                                                         "Country", "IsActive"]))
    assert [(r.RegionKey, r.RegionID) for r in regions.collect()] == [(1, "R_UNK")]
    assert I.region_rows(regions).count() == 0  # idempotent

    p0 = _empty(spark, S.DIM_PRODUCT, ["ProductKey", "ProductID", "ProductName", "Category",
                                       "UnitPrice", "IsActive"])
    products = I.product_rows(p0, tx)
    prods = {r.ProductID: (r.ProductKey, r.ProductName) for r in products.collect()}
    # one id for two spellings; keys follow the business key order
    assert prods == {"PROD_BEAUTY": (1, "Beauty Item"), "PROD_CLOTHING": (2, "Clothing Item"),
                     "PROD_HOME_GOODS": (3, "Home Goods Item")}
    assert I.product_rows(products, tx).count() == 0

    c0 = _empty(spark, S.DIM_CUSTOMER, ["CustomerKey", "CustomerID", "CustomerName", "Email",
                                        "RegistrationDate", "IsCurrentRecord"])
    customers = I.customer_rows(c0, tx, dt.date(2024, 1, 1))
    assert sorted((r.CustomerKey, r.CustomerID) for r in customers.collect()) == [
        (1, "CUST_7"), (2, "CUST_8"), (3, "CUST_9")]

    calendar = dim_date(spark)  # 2020-01-01 .. 2030-12-31
    classified = I.classify_facts(tx, customers, products, regions, calendar)
    reasons = {r.OrderID: r.RejectReason for r in classified.collect()}
    assert reasons == {"ORD_1": None, "ORD_2": "bad_date", "ORD_3": "date_not_in_calendar",
                       "ORD_4": "quantity_not_positive", "ORD_5": "bad_quantity", "ORD_6": None,
                       "ORD_7": None, "ORD_8": None, "ORD_9": "bad_amount"}
    facts = I.load_facts(classified).collect()
    assert sorted(r.SalesID for r in facts) == [1000001, 1000002, 1000003, 1000004]
    assert {r.OrderNumber: r.Quantity for r in facts}["ORD_8"] == 2
    assert {r.RegionKey for r in facts} == {1} and {r.ReturnFlag for r in facts} == {"N"}
    more = I.load_facts(classified, spark.createDataFrame(
        [(f.SalesID,) for f in facts], "SalesID long"))
    assert sorted(r.SalesID for r in more.collect()) == [1000005, 1000006, 1000007, 1000008]


def test_empty_file(spark, tmp_path):
    path = tmp_path / "empty.csv"
    path.write_text("")
    assert I.read_transactions(spark, str(path)).count() == 0


def test_calendar(spark):
    cal = dim_date(spark)
    assert cal.count() == 4018
    first = cal.where(F.col("DateKey") == 20200101).first()
    assert (first.DayName, first.MonthName, first.DayOfWeek, first.WeekOfYear, first.IsWeekend) == (
        "Wednesday", "January", 4, 1, False)


def test_files_with_another_column_order_fail(spark, tmp_path):
    lines = CSV.splitlines()
    (tmp_path / "a.csv").write_text("\n".join(lines[:3]) + "\n")
    columns = [line.split(",") for line in lines[:2]]
    (tmp_path / "b.csv").write_text("\n".join(",".join(reversed(c)) for c in columns) + "\n")
    with pytest.raises(Exception, match="header"):
        I.read_transactions(spark, str(tmp_path)).collect()


def test_load_feed_twice(spark, tmp_path):
    """Dimensions do not change on the second run; facts and rejects are appended."""
    path = tmp_path / "tx.csv"
    path.write_text(CSV)
    raw = I.read_transactions(spark, str(path))
    warehouse = str(tmp_path / "warehouse")

    def rows(name):
        return sorted(map(str, warehouse_table(spark, warehouse, name).collect()))
    load_feed(raw, warehouse, dim_date(spark), dt.date(2024, 1, 1))
    before = {t: rows(t) for t in TABLES}
    assert [len(v) for v in before.values()] == [1, 3, 3]
    assert len(rows(FACTS)) == 4 and len(rows(REJECTS)) == 5
    load_feed(raw, warehouse, dim_date(spark), dt.date(2024, 2, 1))
    assert {t: rows(t) for t in TABLES} == before
    sales = warehouse_table(spark, warehouse, FACTS)
    assert sorted(r.SalesID for r in sales.collect()) == list(range(1000001, 1000009))
    assert len(rows(REJECTS)) == 10
    reasons = warehouse_table(spark, warehouse, REJECTS).select("RejectReason").distinct().count()
    assert reasons == 5


def test_load_that_breaks_off_is_rerun(spark, tmp_path, monkeypatch):
    """Killed between any two writes, a batch stays invisible; run again it ends as a clean run."""
    path = tmp_path / "tx.csv"
    path.write_text(CSV)
    raw = I.read_transactions(spark, str(path))
    days = dim_date(spark)
    first, second = raw.where("`Customer ID` = '7'"), raw.where("`Customer ID` <> '7'")
    clean, broken = str(tmp_path / "clean"), str(tmp_path / "broken")

    def tables(warehouse):
        return {t: sorted(map(str, warehouse_table(spark, warehouse, t).collect()))
                for t in (*TABLES, FACTS, REJECTS)}
    for warehouse in (clean, broken):
        load_feed(first, warehouse, days, dt.date(2024, 1, 1), "2024-01-01")
    before = tables(broken)
    load_feed(second, clean, days, dt.date(2024, 1, 2), "007")
    real = ingest_job.write_table
    for broken_at in (2, 4, 5, 6):             # after regions, customers, rejects, facts
        writes = []

        def failing(*args, **more):
            writes.append(args)
            if len(writes) == broken_at:
                raise RuntimeError("killed")
            real(*args, **more)
        monkeypatch.setattr(ingest_job, "write_table", failing)
        with pytest.raises(RuntimeError, match="killed"):
            load_feed(second, broken, days, dt.date(2024, 1, 2), "007")
        assert tables(broken) == before
    monkeypatch.setattr(ingest_job, "write_table", real)
    for _ in range(2):                         # a loaded batch is not loaded again
        load_feed(second, broken, days, dt.date(2024, 1, 2), "007")
        assert tables(broken) == tables(clean)


LINES = """Transaction ID,Date,Customer ID,Product Category,Quantity,Price per Unit,Total Amount,Gender
1,2023-01-05,7,Beauty,2,50,100,F
2,2023-01-06,70,Beauty,2
3,2023-01-07,71,Toys,2,50,100,F,surplus

4,2023-01-08,7,"Home, Garden",1,5,5,M
5
6,2023-01-09,,,,,,
"""


def test_malformed_lines_are_kept_whole(spark, tmp_path):
    """Too few or too many fields: nothing of the line is read, the line and its file are kept."""
    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "a.csv").write_text(LINES)
    (folder / "b.csv").write_text(LINES.splitlines()[0] + "\n")
    raw = I.read_feed(spark, str(folder))
    assert raw.columns == [*I.RAW_COLUMNS, I.BAD_LINE, I.SOURCE_FILE]
    rows = raw.collect()
    assert all(r[I.SOURCE_FILE].endswith("/feed/a.csv") for r in rows)
    bad = {r[I.BAD_LINE]: r for r in rows if r[I.BAD_LINE] is not None}
    assert set(bad) == {"2,2023-01-06,70,Beauty,2", "3,2023-01-07,71,Toys,2,50,100,F,surplus", "5"}
    assert all(r[c] is None for r in bad.values() for c in I.RAW_COLUMNS)
    assert {r["Transaction ID"]: r["Product Category"] for r in rows if r[I.BAD_LINE] is None} == {
        "1": "Beauty", "4": "Home, Garden", "6": None}

    warehouse = str(tmp_path / "warehouse")
    load_feed(raw, warehouse, dim_date(spark), dt.date(2024, 1, 1), "lines")
    # a second batch without lines has the same columns
    load_feed(I.read_transactions(spark, str(folder / "a.csv")).where("`Transaction ID` = '6'"),
              warehouse, dim_date(spark), dt.date(2024, 1, 2), "rows")
    rejects = warehouse_table(spark, warehouse, REJECTS).collect()
    assert sorted((r.RejectReason, r[I.BAD_LINE]) for r in rejects if r[I.BAD_LINE]) == [
        ("bad_line", line) for line in sorted(bad)]
    assert [(r.OrderID, r.RejectReason) for r in rejects if not r[I.BAD_LINE]] == 2 * [
        ("ORD_6", "bad_quantity")]
    # no dimension takes a key of a malformed line
    customers = warehouse_table(spark, warehouse, "dim_customer").collect()
    assert [r.CustomerID for r in customers] == ["CUST_7"]
    products = warehouse_table(spark, warehouse, "dim_product").collect()
    assert sorted(r.ProductID for r in products) == ["PROD_BEAUTY", "PROD_HOME,_GARDEN"]
    assert warehouse_table(spark, warehouse, FACTS).count() == 2


def test_empty_feed_of_lines(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    feed = I.read_feed(spark, str(tmp_path / "empty.csv"))
    assert feed.count() == 0 and feed.columns == [*I.RAW_COLUMNS, I.BAD_LINE, I.SOURCE_FILE]


def test_no_scratch_folder_on_a_cluster():
    assert scratch_folder("local[4]")
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_folder(master)


def test_staged_load_writes_narrow_rows_once(spark, tmp_path, monkeypatch):
    """A feed that is a table is not written again; rows meet their keys without derived columns."""
    (tmp_path / "tx.csv").write_text(CSV)
    raw = I.read_transactions(spark, str(tmp_path / "tx.csv"))
    staged, real = [], ingest_job.cut_lineage

    def recorded(df):
        staged.append(df.columns)
        return real(df)
    monkeypatch.setattr(ingest_job, "cut_lineage", recorded)
    tables = {}
    for name, more in (("one", {}), ("two", {"staged": True})):
        load_feed(raw, str(tmp_path / name), dim_date(spark), dt.date(2024, 1, 1), **more)
        tables[name] = {t: sorted(map(str, warehouse_table(spark, str(tmp_path / name), t).collect()))
                        for t in (*TABLES, FACTS, REJECTS)}
    assert tables["one"] == tables["two"]
    assert len(staged) == 3                    # the feed of the first load, and both loads' keyed rows
    for columns in staged:
        assert not {"ProductID", "ProductName", "CustomerName", "Email", "Region", "SalesAmount"} & set(columns)
    rejects = warehouse_table(spark, str(tmp_path / "two"), REJECTS)
    assert {(r.OrderID, r.Email, r.ProductName) for r in rejects.collect()} >= {
        ("ORD_4", "cust_8@example.com", "Home Goods Item")}


def test_constant_columns_are_not_sorted(spark, tmp_path, monkeypatch):
    (tmp_path / "tx.csv").write_text(CSV)
    seen, real = [], I.global_row_number

    def recorded(df, order, **more):
        seen.append(set(df.columns))
        return real(df, order, **more)
    monkeypatch.setattr(I, "global_row_number", recorded)
    load_feed(I.read_transactions(spark, str(tmp_path / "tx.csv")), str(tmp_path / "w"), dim_date(spark),
              dt.date(2024, 1, 1))
    constant = {"OrderLineNumber", "DiscountAmount", "TaxAmount", "ReturnFlag"}
    assert "NetSalesAmount" in seen[-1] and not constant & seen[-1]
    rows = warehouse_table(spark, str(tmp_path / "w"), FACTS).collect()
    assert {(r.OrderLineNumber, r.DiscountAmount, r.TaxAmount, r.ReturnFlag) for r in rows} == {(1, 0, 0, "N")}
    assert warehouse_table(spark, str(tmp_path / "w"), FACTS).schema["TaxAmount"].dataType.simpleString() == "decimal(10,2)"


def test_feed_joins_the_lines_once(spark):
    from data_folders import SMALL

    from clientele.sources.testdata import DAMAGE_EVERY, load_star
    star = load_star(spark, SMALL)
    feed = star.feed()
    plan = feed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2             # orders and parts
    copies = feed.where("`Transaction ID` LIKE 'D%'")
    lines = star.raw_transactions().where(F.col("`Transaction ID`").cast("long") % DAMAGE_EVERY <= 8)
    assert copies.count() == lines.count() > 0
    assert feed.exceptAll(copies).exceptAll(star.raw_transactions()).count() == 0
