from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from sojourn.plans import serving


def test_sums_of_pieces_are_sums_of_digests(spark):
    """Both halves against whole digests added up in Python, by range and in all; no decimal is summed row by row."""
    df = spark.range(3000).select(F.when(F.col("id") % 7 != 0, F.col("id")).alias("k"), (F.col("id") % 11).cast("string").alias("v"))
    sums: dict[str, list[int]] = {}
    for k, v in df.collect():
        text = ("n" if k is None else f"v{len(str(k))}:{k}") + f"v{len(v)}:{v}"
        digest = hashlib.md5(text.encode()).hexdigest()
        place = hashlib.md5(("" if k is None else str(k)).encode()).hexdigest()[:2]
        n, high, low = sums.get(place, (0, 0, 0))
        sums[place] = [n + 1, high + int(digest[:16], 16), low + int(digest[16:], 16)]
    modulus = serving.FINGERPRINT_MODULUS
    leaves = serving.range_fingerprints(df, "k")
    got = {r["key_range"]: [r["n_rows"], r["fingerprint"], r["fingerprint_low"]] for r in leaves.collect()}
    assert got == {key: [n, high % modulus, low % modulus] for key, (n, high, low) in sums.items()}
    whole = serving.table_fingerprint(df).first()
    assert list(whole) == [sum(s[0] for s in sums.values()), *[sum(s[i] for s in sums.values()) % modulus for i in (1, 2)]]
    assert list(serving.table_fingerprint(df.filter("false")).first()) == [0, 0, 0]
    # one digest a row, beside the hash of its key, and no sum of decimals
    plan = leaves._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 2 and "sum(cast(conv(substring(_digest" in plan, plan
