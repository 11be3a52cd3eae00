"""The command line runs a whole build, summary, check and vacuum."""

from __future__ import annotations

from tests.conftest import SF_ORACLE
from unilake.session import fresh_dir


def test_cli_build_check_summary_vacuum(spark, capsys, monkeypatch):
    import unilake.__main__ as cli
    # reuse the test session: build_session() returns it, stop() is a no-op here
    monkeypatch.setattr(cli, "build_session", lambda master: spark)
    monkeypatch.setattr(spark, "stop", lambda: None)
    lake = fresh_dir(spark, "cli-lake")
    models = ["--model", "int_unified_customers", "--model", "int_unified_products"]
    assert cli.main(["build", "--namespace", "cli_", "--lake", lake, "--sf-dir", SF_ORACLE] + models) == 0
    out = capsys.readouterr().out
    assert "int_unified_customers" in out and "1600" in out and "4000" in out
    assert cli.main(["check", "--namespace", "cli_", "--lake", lake] + models) == 0
    assert cli.main(["summary", "--namespace", "cli_", "--lake", lake, "--model", "int_unified_customers"]) == 0
    assert "smallest keys" in capsys.readouterr().out
    assert cli.main(["vacuum", "--namespace", "cli_", "--lake", lake, "--keep", "1"] + models) == 0
    assert "deleted 0 folders" in capsys.readouterr().out   # one load: nothing to merge
