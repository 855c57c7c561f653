"""The two commands, on the extracts of the load tests."""

import csv
import glob

from bazaarlens.__main__ import REPORTS, main
from test_loading import extracts


def test_load_and_reports(spark, tmp_path, capsys):
    source = tmp_path / "source"
    source.mkdir()
    main(["load", extracts(source), "by_command", str(tmp_path / "tables")])
    assert "order_reviews" in capsys.readouterr().out
    main(["reports", "by_command", str(tmp_path / "reports"), "--only", "monthly_revenue", "top_categories"])
    (path,) = glob.glob(str(tmp_path / "reports/monthly_revenue/*.csv"))
    with open(path) as file:
        rows = list(csv.DictReader(file))
    assert [r["month"] for r in rows] == ["2017-10", "2017-11"]
    assert len(REPORTS) == 10
