import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001
from ticklab.sources.incremental import current_snapshot, read_since
from ticklab.sources.jdbc import day_predicates, jdbc_options, select_list
from ticklab.sources.ticks import load_ticks, read_ticks, write_ticks


def test_jdbc_options_and_day_predicates():
    preds = day_predicates(dt.date(2024, 1, 1), dt.date(2024, 1, 4))
    assert len(preds) == 3
    assert preds[0].startswith("changed_time >= '2024-01-01 00:00:00' AND changed_time < '2024-01-02 00:00:00'")
    assert all("asth_bidPrice > 0 AND asth_askPrice > 0" in p for p in preds)
    opts = jdbc_options("jdbc:mysql://db/x", user="u", password="p", driver="com.mysql.cj.jdbc.Driver")
    assert "WHERE asth_bidPrice > 0" in opts["dbtable"] and "asth_id AS tick_id" in opts["dbtable"]
    assert opts["user"] == "u" and opts["fetchsize"] == "10000"
    assert "ast_bidPrice AS bid_price" in select_list(prefix_to="ast_")


def test_csv_round_trip_with_coercion(spark, tmp_path):
    t = load_ticks(spark, SF001)
    out = str(tmp_path / "csv")
    write_ticks(t, out, fmt="csv")
    back = read_ticks(spark, out, fmt="csv")
    assert back.count() == t.count()
    assert dict(back.dtypes)["bid_price"] == "double" and dict(back.dtypes)["tick_id"] == "bigint"
    j = back.alias("b").join(t.alias("t"), "tick_id")
    assert j.where("NOT (b.bid_price <=> t.bid_price) OR NOT (b.symbol <=> t.symbol)").count() == 0


def test_snapshot_prefix_and_read_since(spark):
    t = load_ticks(spark, SF001)
    renamed = t.select([F.col(c).alias(c if c in ("event_time",) else f"ast_{c}") for c in t.columns])
    snap = current_snapshot(renamed, prefix="ast_")
    rows = snap.collect()
    assert len(rows) == 15 and rows[0].event_time >= rows[-1].event_time
    mark = t.agg(F.max("event_time")).first()[0] - dt.timedelta(days=1)
    batch = read_since(t, mark, 50).collect()
    after = t.where((F.col("event_time") > mark) & (F.col("bid_price") > 0) & (F.col("ask_price") > 0)).count()
    assert len(batch) == min(50, after) and all(r.event_time > mark for r in batch)
    assert [r.event_time for r in batch] == sorted(r.event_time for r in batch)


def test_load_report(spark):
    from ticklab.operators.quality import load_report

    before = spark.range(10)
    r = load_report(before, before.where("id < 4")).first()
    assert (r.rows_read, r.rows_kept, r.rows_removed, r.pct_kept) == (10, 4, 6, 40.0)


def _tuple(i, text):
    return f"({i},'S1','EUR',1,2,3,4,5,6,7,{100 + i},8,9,10,11,12,13,14,15,'N',{text},5,'2024-01-01 00:00:{i:02d}')"


def _dump(spark, tmp_path, text, name="d.sql"):
    from ticklab.sources.dump import dump_rejects, read_sql_dump

    path = tmp_path / name
    path.write_bytes(text.encode())
    ticks = {r.tick_id: (r.bid_price, r.changed_by) for r in read_sql_dump(spark, str(path)).collect()}
    return ticks, [r.body for r in dump_rejects(spark, str(path)).collect()]


def test_dump_line_ends_and_one_line(spark, tmp_path):
    head = "-- made by a dump tool\nINSERT INTO `assets_history` (`a`, `b`) VALUES "
    rows = [_tuple(i, "'t'") for i in range(1, 6)]
    want = {i: (100.0 + i, "t") for i in range(1, 6)}
    for k, between in enumerate([",\r\n", ",\n", ",", " ,\t"]):
        text = head + between.join(rows[:3]) + ";\r\n" + head + between.join(rows[3:]) + ";\nCOMMIT;\n"
        assert _dump(spark, tmp_path, text, f"{k}.sql") == (want, []), between


def test_dump_quoting(spark, tmp_path):
    long = "x" * 50_000 + "''" * 3000
    cases = {1: (r"'it\'s'", "it's"), 2: (r"'a\\'", "a\\"), 3: (r"'\\\'\\'", "\\'\\"), 4: ("'NULL'", "NULL"), 5: ("NULL", None), 6: ("'),(1,2),\n('", "),(1,2),\n("),
             7: ("');\nINSERT INTO x VALUES (1'", ");\nINSERT INTO x VALUES (1"), 8: (f"'{long}'", long.replace("''", "'")), 9: ("'a),\r\n'", "a),\r\n"), 10: ("'-- no comment'", "-- no comment")}
    text = "INSERT INTO t VALUES\n" + ",\n".join(_tuple(i, q) for i, (q, _) in cases.items()) + ";\n"
    ticks, rejects = _dump(spark, tmp_path, text)
    assert rejects == [] and {i: t for i, (_, t) in ticks.items()} == {i: t for i, (_, t) in cases.items()}


def test_dump_rejects_are_returned(spark, tmp_path):
    text = "INSERT INTO t VALUES\n" + _tuple(1, "'t'") + ",\n(1,'too short'),\n" + _tuple(2, "'t'") + ";\nUPDATE t SET x = 1;\n"
    ticks, rejects = _dump(spark, tmp_path, text)
    assert set(ticks) == {1, 2} and sorted(rejects) == ["1,'too short'", "UPDATE t SET x = 1"]


def test_dump_of_any_slice_reads_back(spark, tmp_path):
    from ticklab.sources.dump import read_sql_dump, write_sql_dump

    odd = F.when(F.col("tick_id") % 3 == 0, F.lit("\\'),(\\")).otherwise(F.col("changed_by"))
    t = load_ticks(spark, SF001).where("tick_id % 7 <> 0").withColumn("changed_by", odd)
    write_sql_dump(t, str(tmp_path / "out"), rows_per_insert=50, between=",\r\n")
    back = read_sql_dump(spark, str(tmp_path / "out"))
    assert back.count() == t.count()
    j = back.alias("b").join(t.alias("t"), "tick_id")
    assert j.where("NOT (b.changed_by <=> t.changed_by) OR NOT (b.bid_price <=> t.bid_price)").count() == 0


def test_jdbc_slices_use_the_columns_they_select(spark):
    from ticklab.sources.jdbc import read_jdbc_ticks, source_table

    query = f"SELECT * FROM {source_table('h')} WHERE {day_predicates(dt.date(2024, 1, 1), dt.date(2024, 1, 2))[0]}"
    inner = query[query.index("(SELECT ") + 8:query.index(" FROM h)")].split(", ")
    for name in ("changed_time", "asth_bidPrice", "asth_askPrice"):
        assert name in inner and name in query[query.index("WHERE"):]
    try:
        read_jdbc_ticks(spark, "jdbc:none:x")
    except ValueError as e:
        assert "required" in str(e)
    else:
        raise AssertionError("a read without slices must be refused")
