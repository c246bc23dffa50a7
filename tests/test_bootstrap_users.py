"""The registered bootstrap draws each user, in its plan and in its SQL; other queries keep their SQL."""

from lodestride.operators import ope
from lodestride.plans import ORACLES, catalogue


def test_bootstrap_query_draws_users(spark, monkeypatch):
    drawn = []
    monkeypatch.setattr(ope, "bootstrap", lambda rows, **given: drawn.append(given.get("units", ope.UNITS)) or spark.range(1))
    monkeypatch.setattr(catalogue, "observations", lambda spark, d: spark.range(1))
    catalogue.bootstrap_ope(spark, "")
    assert drawn == [None] and "_unit" not in ORACLES["bootstrap_ope"]
    assert "_unit" in ORACLES["ab_lift"] and f"% {ope.UNITS}" in ORACLES["ab_lift"]
