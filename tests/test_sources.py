"""Captures, chunk files, archives, result files and the command line."""

import json

import pytest
from pyspark.sql import functions as F

from checks import DATA
from packetlens import __main__ as cli
from packetlens import session
from packetlens.functions.packet import FIELDS, parse_packets
from packetlens.operators import conversations, names, pairs
from packetlens.plans import hive_views
from packetlens.sources import archive, capture, checked, derived, output, topic
from packetlens.streaming import jobs
from packetlens.streaming.serving import SERVING, Serving

SF = f"{DATA}/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def captures(tmp_path):
    folder = tmp_path / "captures"
    folder.mkdir()
    head = '"No.","Time","Source","Destination","Protocol","Length","Info"\n'
    (folder / "h1.csv").write_text(
        head + '"1","0.1","1.1.1.1","2.2.2.2","DNS","60","Standard query 0x1 A caf\xe9.fr"\n'
        '"2","0.2","1.1.1.1","2.2.2.2","MDNS","70","Standard query 0x0 PTR x, ""QM"" q"\n',
        encoding="latin-1")
    (folder / "h2.csv").write_text(
        head + "".join(f'"{i}","1.{i}","3.3.3.3","4.4.4.4","TCP","{i}","a > b"\n' for i in range(7)),
        encoding="latin-1")
    return folder


def test_captures_to_chunks_to_packets(spark, captures, tmp_path):
    read = capture.read_captures(spark, [str(captures / "h1.csv"), str(captures / "h2.csv")])
    assert read.columns == ["src", "dst", "protocol", "length", "info"]
    assert read.count() == 9
    chunks = tmp_path / "chunks"
    capture.write_chunks(read, str(chunks), rows_per_file=3)
    files = list(chunks.glob("*.csv"))
    assert all(len(f.read_text(encoding="utf-8").splitlines()) <= 3 for f in files)
    lines = [line for f in files for line in f.read_text(encoding="utf-8").splitlines()]
    assert len(lines) == 9
    assert "1.1.1.1,2.2.2.2,DNS,60,Standard query 0x1 A caf\xe9.fr" in lines
    assert '1.1.1.1,2.2.2.2,MDNS,70,"Standard query 0x0 PTR x, ""QM"" q"' in lines
    parsed = parse_packets(capture.read_lines(spark, str(chunks)))
    assert parsed.where("protocol = 'TCP'").agg(F.sum("length")).first()[0] == 21


def test_watched_folder_reads_each_csv_once(spark, tmp_path):
    folder, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    (tmp_path / "in").mkdir()

    def run():
        lines = capture.watch_lines(spark, folder, files_per_trigger=1)
        jobs.run_available(topic.topic_writer(lines, cp, "parquet", path=out))
        return [json.loads(r.value)["payload"]["message"]
                for r in spark.read.parquet(out).collect()]

    (tmp_path / "in" / "data0.csv").write_text("a,b,DNS,1,x\nc,d,DNS,2,y\n")
    (tmp_path / "in" / "note.txt").write_text("no packets\n")
    assert sorted(run()) == ["a,b,DNS,1,x", "c,d,DNS,2,y"]
    (tmp_path / "in" / "data1.csv").write_text("e,f,DNS,3,z\n")
    assert sorted(run()) == ["a,b,DNS,1,x", "c,d,DNS,2,y", "e,f,DNS,3,z"]


def test_archive_files_and_partitions(spark, tmp_path):
    feed, out = str(tmp_path / "topic"), tmp_path / "archive"
    derived.topic_records(spark, SF).write.parquet(feed)
    source = topic.read_topic(spark, "parquet", path=feed)
    jobs.run_available(archive.archive_writer(source, str(out), str(tmp_path / "cp"), 100))
    assert {p.name for p in out.glob("partition=*")} == {f"partition={k}" for k in range(4)}
    files = list(out.glob("partition=*/*.json"))
    assert all(len(f.read_text().splitlines()) <= 100 for f in files)
    assert all(list(json.loads(line)) == ["message"] for line in files[0].read_text().splitlines())
    want = derived.packet_lines(spark, SF).select("message")
    assert rows(archive.read_archive(spark, str(out))) == rows(want)


def test_archive_reader_leaves_out_broken_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"message":"a,b,DNS,1,x"}\nnot json\n{"other":1}\n')
    assert rows(archive.read_archive(spark, str(tmp_path))) == [("a,b,DNS,1,x",)]


def test_packet_table_is_pruned_and_filtered_at_the_scan(spark, tmp_path):
    path = str(tmp_path / "table")
    archive.write_packet_table(derived.packets(spark, SF), path)
    result = pairs.pair_traffic(archive.read_packet_table(spark, path))
    assert rows(result) == rows(pairs.pair_traffic(derived.packets(spark, SF)))
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(protocol,DNS)" in plan
    assert "ReadSchema: struct<src:string,dst:string,protocol:string,length:bigint>" in plan


def test_tsv(spark, tmp_path):
    result = pairs.pair_traffic_rounded(derived.packets(spark, SF))
    path = tmp_path / "one"
    output.write_tsv(result, str(path), single_file=True)
    assert len(list(path.glob("part-*"))) == 1
    schema = "address_a string, address_b string, total bigint, avg double, count bigint"
    got = [tuple(r) for r in output.read_tsv(spark, str(path), schema).collect()]
    assert got == [tuple(r) for r in result.collect()]
    totals = [r[2] for r in got]
    assert totals == sorted(totals, reverse=True)


def test_ranked_results_are_in_order(spark):
    p = derived.packets(spark, SF)
    averages = [r.average for r in pairs.pair_average_ranked(p).collect()]
    assert averages == sorted(averages, reverse=True)
    counts = [r["count"] for r in names.unique_hosts_ranked(p).collect()]
    assert counts == sorted(counts, reverse=True)


def test_kafka_reader_names_its_source(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        topic.read_topic(spark, **{"kafka.bootstrap.servers": "nowhere:9092"})


def test_work_dir_is_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = session.work_dir(spark, "x"), session.work_dir(spark, "x")
    assert first.startswith(f"{base}/x-") and first != second


def test_command_line(spark, tmp_path, monkeypatch, captures):
    monkeypatch.setattr(cli, "build_session", lambda app: spark)
    feed, root = str(tmp_path / "topic"), str(tmp_path / "serving")
    arch = str(tmp_path / "archive")
    derived.topic_records(spark, SF).write.parquet(feed)
    source = ["--format", "parquet", "--option", f"path={feed}", "--once"]
    cli.main(["create", "--serving", root])
    cli.main(["archive", "--output_path", arch, "--checkpoint", f"{root}/cp-a", *source])
    for job in ("nameservers", "window_bytes_packets"):
        cli.main(["stream", job, "--serving", root, "--checkpoint", f"{root}/cp-{job}", *source])
    for job in ("packets_total_avg_len", "requests_and_responses_uniquehosts", "find_host"):
        cli.main(["batch", job, "--input_path", arch, "--serving", root])
    for job in ("packets_total_avg_len_rounded", "packets_average_ranked", "uniquehosts_dns",
                "uniquehosts_ranked", "uniquehosts_views", "requests_and_responses_uniquehosts",
                "message_types", "errors", "nameservers", "names", "categories", "conversations"):
        out = str(tmp_path / f"out-{job}")
        cli.main(["batch", job, "--input_path", arch, "--output_path", out])
        assert spark.read.text(out).count() > 0
    cli.main(["stream", "message_types", "errors", "--serving", root, "--checkpoint",
              f"{root}/cp-shared", *source])
    cli.main(["table", "--input_path", arch, "--output_path", str(tmp_path / "table")])
    cli.main(["batch", "uniquehosts_dns", "--input_path", str(tmp_path / "table"),
              "--input_format", "table", "--output_path", str(tmp_path / "out-table")])
    assert rows(spark.read.text(str(tmp_path / "out-table"))) == rows(
        spark.read.text(str(tmp_path / "out-uniquehosts_dns")))
    cli.main(["compact", "--serving", root])
    cli.main(["chunk", "--input_path", str(captures), "--output_path", str(tmp_path / "chunks")])
    cli.main(["ingest", "--watch", str(tmp_path / "chunks"), "--checkpoint", f"{root}/cp-i",
              "--format", "parquet", "--option", f"path={tmp_path / 'out-topic'}", "--once"])
    assert spark.read.parquet(str(tmp_path / "out-topic")).count() == 9
    serving = Serving(spark, root)
    p = derived.packets(spark, SF)
    assert rows(serving.read(SERVING["total_avg_bytes"])) == rows(pairs.pair_traffic(p))
    assert serving.read(SERVING["hosts"]).count() > 0
    talks = spark.read.csv(str(tmp_path / "out-conversations"), sep="\t")
    static = conversations.conversations(conversations.messages(p, "seq", "ts"))
    assert talks.count() == static.count()
    with pytest.raises(ValueError):
        cli.main(["batch", "find_host", "--input_path", arch])
    with pytest.raises(ValueError):
        cli.main(["batch", "uniquehosts_dns", "--input_path", arch])


def test_exact_chunks_of_several_files_and_splits(spark, tmp_path):
    folder = tmp_path / "captures"
    folder.mkdir()
    head, want = '"No.","Time","Source","Destination","Protocol","Length","Info"\n', []
    for name, n in (("h1", 700), ("h2", 0), ("h10", 1001), ("h3", 1), ("h4", 999)):
        rows_ = [(f"{name}-{i}", "2.2.2.2", "DNS", str(i), 'a, "b" \xe9') for i in range(n)]
        (folder / f"{name}.csv").write_text(
            head + "".join(f'"{i}","0.1","{r[0]}","{r[1]}","{r[2]}","{r[3]}","a, ""b"" \xe9"\n'
                           for i, r in enumerate(rows_)), encoding="latin-1")
    for name, n in (("h1", 700), ("h3", 1), ("h4", 999), ("h10", 1001)):
        want += [(f"{name}-{i}", "2.2.2.2", "DNS", str(i), 'a, "b" \xe9') for i in range(n)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        numbered = capture.numbered_captures(spark, str(folder))
        assert spark.read.csv(str(folder)).rdd.getNumPartitions() > 8
        got = sorted(tuple(r) for r in numbered.select("seq", *FIELDS).collect())
        capture.write_exact_chunks(numbered, str(tmp_path / "chunks"), 400)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [(i, *r) for i, r in enumerate(want)]
    for k in range(7):
        files = list((tmp_path / "chunks" / f"chunk={k}").glob("*.csv"))
        assert len(files) == 1
        lines = files[0].read_text(encoding="utf-8").splitlines()
        assert lines == [f'{r[0]},{r[1]},{r[2]},{r[3]},"a, ""b"" \xe9"' for r in want[400 * k:400 * k + 400]]
    back = capture.read_chunks(spark, str(tmp_path / "chunks"))
    assert sorted(back.groupBy("chunk").count().collect()) == [(k, 400 if k < 6 else 301) for k in range(7)]


def test_captures_without_rows(spark, tmp_path):
    (tmp_path / "h1.csv").write_text('"No.","Time","Source","Destination","Protocol","Length","Info"\n')
    numbered = capture.numbered_captures(spark, str(tmp_path))
    capture.write_exact_chunks(numbered, str(tmp_path / "chunks"))
    assert numbered.count() == 0


def test_paths_sort_by_their_numbers(spark):
    paths = ["a/h10.csv", "a/h9.csv", "a/h1.csv", "a/h.csv", "a10/h1.csv", "a2/h1.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r.p for r in df.orderBy(capture.natural(F.col("p"))).collect()]
    assert got == ["a/h.csv", "a/h1.csv", "a/h9.csv", "a/h10.csv", "a2/h1.csv", "a10/h1.csv"] or \
        [g for g in got if g != "a/h.csv"] == ["a/h1.csv", "a/h9.csv", "a/h10.csv", "a2/h1.csv", "a10/h1.csv"]


def test_every_line_is_parsed_or_quarantined(spark, tmp_path):
    lines = ["1.1.1.1,2.2.2.2,DNS,60,Standard query 0x1 A a.b", "", None, "a,b,c,1", "a,b,c,1.5,x", "a,b,c,,x", "a,b,c,7,",
             "a,b,c,8,x,y", "  a,b,c,9,x \n"]
    df = spark.createDataFrame(list(enumerate(lines)), "offset int, message string")
    assert checked.write_checked(df, str(tmp_path / "out")) == {"read": 9, "parsed": 3, "quarantined": 6}
    bad = checked.read_checked(spark, str(tmp_path / "out"), checked.QUARANTINED)
    assert sorted((r.offset, r.reason) for r in bad.collect()) == [
        (1, "too few fields"), (2, "no record"), (3, "too few fields"), (4, "length"), (5, "length"), (6, "no text")]
    good = checked.read_checked(spark, str(tmp_path / "out"), checked.PARSED)
    assert sorted(tuple(r) for r in good.select("offset", "length", "info", "reason").collect()) == [
        (0, 60, "Standard query 0x1 A a.b", None), (7, 8, "x", None), (8, 9, "x", None)]


def test_an_input_table_is_loaded_anew(spark, tmp_path):
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "a.json").write_text('{"message":"x"}\n{"message":"y"}\n')
    spark.sql(f"CREATE DATABASE loads LOCATION '{tmp_path}/db'")
    try:
        for _ in range(2):
            hive_views.load_archive(spark, "loads.input", str(tmp_path / "one"), str(tmp_path / "external"))
            assert spark.table("loads.input").count() == 2
        kind = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED loads.input").collect()}
        assert kind["Type"] == "EXTERNAL"
    finally:
        spark.sql("DROP DATABASE loads CASCADE")
    assert spark.read.text(str(tmp_path / "external")).count() == 2


def test_pair_tables_are_dropped(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = ["9,5,DNS,60,x", "5,9,DNS,40,x", "5,5,DNS,7,x", "3,4,DNS,10,x", "3,4,TCP,10,x", "3,4,DNS,oops,x"]
    (tmp_path / "in" / "a.json").write_text("".join(f'{{"message":"{m}"}}\n' for m in lines))
    got = sorted(tuple(r) for r in hive_views.pair_averages_by_tables(spark, str(tmp_path / "in")).collect())
    assert got == [("3", "4", 10.0, 1.0), ("5", "5", 7.0, 2.0), ("9", "5", 50.0, 2.0)]
    assert not [d for d in spark.catalog.listDatabases() if d.name.startswith("pairs_")]
