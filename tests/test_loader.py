import datetime as dt

from orderlens.sources import artifacts, sinks
from orderlens.sources.loader import coerce_timestamps, load_csv_marketplace, load_csv_table, reread_dataset
from orderlens.sources.schemas import SCHEMAS


def _write(path, text, newline="\n"):
    path.write_bytes(text.replace("\n", newline).encode())
    return str(path)


def test_orders_with_empty_timestamps(spark, tmp_path):
    path = _write(
        tmp_path / "orders.csv",
        "order_id,customer_id,order_status,p,a,c,d,e\n"
        '"o1","c1","delivered","2017-10-02 10:56:33","","2017-10-04 19:55:00",,"2017-10-18 00:00:00"\n',
    )
    row = load_csv_table(spark, path, "orders").first()
    assert row["order_purchase_timestamp"] == dt.datetime(2017, 10, 2, 10, 56, 33)
    assert row["order_approved_at"] is None and row["order_delivered_customer_date"] is None


def test_empty_numbers_and_texts(spark, tmp_path):
    path = _write(
        tmp_path / "products.csv",
        "product_id,category,name,description,photos,weight,l,h,w\n"
        '"p1","",40,287,,225,16,10,14\n"p2","perfumaria, fina",1,2,3,oops,1,1,1\n',
    )
    zero = {r["product_id"]: r for r in load_csv_table(spark, path, "products").collect()}
    assert zero["p1"]["product_category_name"] == "" and zero["p1"]["product_photos_qty"] == 0
    assert zero["p2"]["product_category_name"] == "perfumaria, fina" and zero["p2"]["product_weight_g"] == 0
    null = {r["product_id"]: r for r in load_csv_table(spark, path, "products", "null").collect()}
    assert null["p1"]["product_photos_qty"] is None


def test_reviews_with_quotes_newlines_and_crlf(spark, tmp_path):
    path = _write(
        tmp_path / "reviews.csv",
        "review_id,order_id,score,title,message,creation,answer\n"
        '"r1","o1",4,"","said ""ok"", fine\nsecond line","2018-01-18 00:00:00","2018-01-18 21:46:59"\n'
        '"r2","o2",1,,plain,"2018-03-10 00:00:00",\n',
        newline="\r\n",
    )
    rows = {r["review_id"]: r for r in load_csv_table(spark, path, "order_reviews").collect()}
    assert set(rows) == {"r1", "r2"}
    message = rows["r1"]["review_comment_message"].replace("\r\n", "\n")
    assert message == 'said "ok", fine\nsecond line'
    assert rows["r1"]["review_answer_timestamp"] == dt.datetime(2018, 1, 18, 21, 46, 59)
    assert rows["r2"]["review_answer_timestamp"] is None and rows["r2"]["review_score"] == 1


def test_marketplace_opens_tables_on_use(spark, tmp_path):
    path = _write(tmp_path / "sellers.csv", 'seller_id,zip,city,state\n"s1","01001","sao paulo","SP"\n')
    t = load_csv_marketplace(spark, {"sellers": path})
    assert t.sellers.schema.names == SCHEMAS["sellers"].names
    assert t.sellers.first()["seller_zip_code_prefix"] == "01001"


def test_sinks_and_profile(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "2018-01-01 10:00:00"), ("b", 2, None)], "k string, n int, ts string")
    timed = coerce_timestamps(df, ("ts", "absent"))
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        sinks.write_dataset(timed, path, fmt)
        sinks.write_dataset(timed, path, fmt)  # replaces
        assert sorted(reread_dataset(spark, path, timed.schema, fmt).collect()) == sorted(timed.collect())
    assert sinks.load_profile(df).first().asDict() == {"row_count": 2, "column_count": 3, "column_names": "k,n,ts"}
    watched, seen = sinks.profiled(df)
    watched.collect()
    assert seen.get["rows"] == 2


def test_artifacts_round_trip(spark, tmp_path):
    artifacts.write_thresholds(spark, {"total_price": 12.5, "freight_ratio": 1.0}, str(tmp_path / "t"))
    assert artifacts.read_thresholds(spark, str(tmp_path / "t")) == {"total_price": 12.5, "freight_ratio": 1.0}
    artifacts.append_run(spark, str(tmp_path / "runs"), "one", {"depth": 6}, {"f1": 0.5})
    log = artifacts.append_run(spark, str(tmp_path / "runs"), "two", {"depth": 7}, {})
    assert sorted((r["run_name"], r["kind"], r["value"]) for r in log.collect()) == [
        ("one", "metric", "0.5"), ("one", "param", "6"), ("two", "param", "7"),
    ]
