"""The command line maps the reference workflow onto the Spark jobs."""

from adtally import __main__ as cli
from adtally import catalog
from adtally.session import scratch_path
from tests.conftest import SF_SMALL


def test_list_and_run(spark, capsys):
    assert cli.main(["list"]) == 0
    assert capsys.readouterr().out.split() == list(catalog.CATALOG)
    out = scratch_path(spark, "cli_run")
    assert cli.main(["run", "dim_publishers", "--sf-dir", SF_SMALL, "--out", out]) == 0
    assert spark.read.parquet(out).count() == 25
    assert cli.main(["run", "no_such_query", "--sf-dir", SF_SMALL]) == 2


def test_data_tests_fail_like_the_reference(spark, capsys):
    # the singular CTR test is designed to fail on the seeded data: 34 of 35 pass, exit 1
    assert cli.main(["test", "--sf-dir", SF_SMALL]) == 1
    assert "34 of 35 passed" in capsys.readouterr().out
