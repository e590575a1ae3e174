"""Stored tables: texts of hex letters take about half their length on disk."""

import os

from tidemark.plans.materialize import Warehouse
from tidemark.plans.pipeline import SPECS


def test_hashes_are_stored_in_about_half_their_letters(spark, tmp_path):
    house, spec = Warehouse(spark, str(tmp_path)), SPECS["core_whale_addresses"]
    house.materialize(spark.range(30_000).selectExpr("concat('0x', sha2(cast(id as string), 256)) address"), spec, full_refresh=True)
    size = sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(house.path(spec.name)) for f in files)
    assert size < 30_000 * 45 and house.read(spec).distinct().count() == 30_000
