import json

from kinspark import cli


def test_evaluate_and_validate(spark, tmp_path, capsys):
    t, f, s, c = (tmp_path / n for n in ("t.tsv", "f.tsv", "s.tsv", "c.tsv"))
    t.write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S3-1\nS1-2\t\n")
    f.write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-8\nS1-2\t\nS1-9\tS1-1\nS1-1\tS2-1\n")  # of S1-1 the last row counts
    s.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\ta\tb\tUS\nS1-2\ta\tb\tUS\nS1-3\ta\tb\tUS\n")
    c.write_text("source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1\nS1-9\tS1-1\n")
    assert cli.main(["evaluate", str(t), str(f), "-q"], spark) == 0
    assert abs(float(capsys.readouterr().out) - (1 + 1.25 * 0.5 / (0.25 + 0.5)) / 2) < 1e-6
    assert cli.main(["evaluate", str(t), str(f), "--json"], spark) == 0
    assert json.loads(capsys.readouterr().out)["singletons_correct"] == 1
    assert cli.main(["validate", str(f), str(s)], spark) == 1
    assert set(json.loads(capsys.readouterr().out)) == {"duplicate_s1", "self_match", "missing_s1", "extra_s1"}
    assert cli.main(["validate", str(f), str(s), "--candidates", str(c), "--known", str(s)], spark) == 1
    got = json.loads(capsys.readouterr().out)
    assert got["not_a_candidate"] == {"severity": "warning", "n": 1, "examples": "S1-1|S2-8"} and got["unknown_id"]["n"] == 2
    assert cli.main(["validate", str(c), str(s)], spark) == 1
    assert "wrong_header" in json.loads(capsys.readouterr().out)
    assert cli.main(["validate", str(tmp_path / "none.tsv"), str(s)], spark) == 1
    assert "missing_file" in capsys.readouterr().out
    f.write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1\nS1-2\t\nS1-3\t\n")
    assert cli.main(["validate", str(f), str(s)], spark) == 0


def test_match_writes_a_line_for_each_reference_record(spark, tmp_path):
    s = tmp_path / "s.tsv"
    rows = [("S1-1", "Halocast Pvt. Ltd.", "12 Lake Road, Kolkata, West Bengal"), ("S2-1", "HALOCAST PRIVATE LIMITED", "12, Lake Rd, Kolkata, WB"), ("S1-2", "Zeta", "1 x")]
    s.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join("\t".join((*r, "India")) + "\n" for r in rows))
    for what, column in (("match", "matched_entity_ids"), ("candidates", "candidate_entity_ids")):
        out = str(tmp_path / what)
        assert cli.main([what, str(s), "--out", out], spark) == 0
        got = spark.read.option("sep", "\t").option("header", True).csv(out).fillna("").collect()
        assert {r.source1_entity_id: r[column] for r in got} == {"S1-1": "S2-1", "S1-2": ""}


def test_files_keep_the_order_of_the_reference_and_the_model_is_saved(spark, tmp_path, capsys):
    s, t = tmp_path / "s.tsv", tmp_path / "t.tsv"
    names = ["alba trading", "brevo works", "corvin lines", "delta mills", "evora stone", "fenwick cloth"]
    order = [17, 3, 44, 8, 25, 1, 30, 12, 9, 40]
    rows = [(f"S1-{i}", f"{names[i % 6]} {i}", f"{i + 10} lake road, austin, tx") for i in order] + [(f"S2-{i}", f"{names[i % 6]} {i}", f"{i + 10} lake rd, austin, tx") for i in order]
    rows += [(f"S3-{i}", f"{names[i % 6]} {i + 1}", f"{i + 70} hill road, austin, tx") for i in order]
    s.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join("\t".join((*r, "US")) + "\n" for r in rows))
    t.write_text("source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{i}\tS2-{i}\n" for i in order))
    assert cli.main(["train", str(s), "--truth", str(t), "--out", str(tmp_path / "model")], spark) == 0
    assert json.loads(capsys.readouterr().out)["written"]
    paths = ["--model", str(tmp_path / "no"), str(tmp_path / "model"), "--cache", str(tmp_path / "pairs")]
    for out in ("m1", "m2"):  # the second from the cache
        assert cli.main(["match", str(s), "--out", str(tmp_path / out), *paths], spark) == 0
        lines = [x for p in sorted((tmp_path / out).glob("part-*")) for x in p.read_text().splitlines() if not x.startswith("source1")]
        assert lines == [f"S1-{i}\tS2-{i}" for i in order]
