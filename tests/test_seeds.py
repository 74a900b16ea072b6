"""Lookups from files: taken whole or refused."""

from decimal import Decimal

import pytest

from starmill.operators.quality import QualityError
from starmill.sources.seeds import rate_seed, region_seed


def file(tmp_path, text):
    (tmp_path / "seed.csv").write_text(text)
    return f"{tmp_path}/seed.csv"


def test_good_seeds(spark, tmp_path):
    rows = region_seed(spark, file(tmp_path, 'country,state,region\nIndia,MH,West\n"Korea, South",11,Seoul\n')).collect()
    assert sorted(map(tuple, rows)) == [("India", "MH", "West"), ("Korea, South", "11", "Seoul")]
    dated = rate_seed(spark, file(tmp_path, "currency,valid_from,inr_rate\nUSD,2025-01-01,85.5\nUSD,2025-02-01,86\n"), dated=True)
    assert sorted(r.inr_rate for r in dated.collect()) == [Decimal("85.5"), Decimal("86")]


@pytest.mark.parametrize(
    "text, found",
    [
        ("currency,inr_rate\nUSD,85\nUSD,86\n", r"unique\(currency\) has 1"),
        ("currency,inr_rate\n,85\n", r"holds\(cells\) has 1"),
        ("currency,inr_rate\nUSD\n", r"holds\(lines\) has 1"),
        ("currency,inr_rate\nUSD,much\n", r"holds\(lines\) has 1"),
        ("currency,inr_rate\nUSD,\n", r"holds\(cells\) has 1"),
        ("currency,inr_rate\n   ,85\n", r"holds\(cells\) has 1"),
    ],
)
def test_wrong_seeds_are_refused(spark, tmp_path, text, found):
    with pytest.raises(QualityError, match=found):
        rate_seed(spark, file(tmp_path, text))
