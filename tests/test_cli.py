from conftest import SF_SMALL
from stratiform.plans import cli, scenario


def test_cli_run_inspect_recover_migrate(spark, scratch, capsys):
    root = scratch("cli")
    lookups = scenario.land_lookups(spark, SF_SMALL, root, broken=False)
    feed = scenario.land_feed(spark, SF_SMALL, root, scenario.RUN2_REF)
    assert cli.main(["--root", root, "run", "--feed", feed, "--lookups", lookups], spark=spark) == 0
    assert cli.main(["--root", root, "silver"], spark=spark) == 0
    assert cli.main(["--root", root, "gold"], spark=spark) == 0
    assert cli.main(["--root", root, "recover", "--lookups", lookups, "--ids", "1,2"], spark=spark) == 0
    assert cli.main(["--root", root, "inspect", "--rows", "2"], spark=spark) == 0
    out = capsys.readouterr().out
    assert "== gold/daily_summary" in out and "orphan_rows" in out
    new = f"{root}/moved"
    assert cli.main(["--root", root, "migrate", "--move",
                     f"gold={root}/gold/neo_feed/daily_summary,{new}/gold"], spark=spark) == 0
    assert spark.read.parquet(f"{new}/gold").count() == spark.read.parquet(f"{root}/gold/neo_feed/daily_summary").count()
    assert cli.main(["--root", root, "reprocess"], spark=spark) == 0


def test_cli_new_files_follow_report_and_diff(spark, scratch, capsys):
    root, other = scratch("cli-new"), scratch("cli-full")
    lookups = scenario.land_lookups(spark, SF_SMALL, root, broken=False)
    feed = scenario.land_feed(spark, SF_SMALL, root, scenario.RUN2_REF)
    assert cli.main(["--root", root, "run", "--new-files", "--feed", feed, "--lookups", lookups], spark=spark) == 0
    assert cli.main(["--root", other, "run", "--report", "--feed", feed, "--lookups", lookups], spark=spark) == 0
    assert "element_count" in capsys.readouterr().out
    rows = [sorted(map(tuple, spark.read.parquet(p).select("fecha", "cantidad_aproximaciones", "velocidad_promedio_km_s").collect()))
            for p in (f"{root}/gold/neo_feed/daily_summary_by_day", f"{other}/gold/neo_feed/daily_summary")]
    assert rows[0] == rows[1] and rows[0]
    assert cli.main(["--root", root, "follow"], spark=spark) == 0
    assert "days written:\n" in capsys.readouterr().out
    assert cli.main(["--root", root, "diff", "--other", other], spark=spark) == 0
    assert "2024" not in capsys.readouterr().out
