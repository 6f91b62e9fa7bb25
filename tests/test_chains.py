"""Chains against the row-by-row rules, on random logs with hubs, self rows, terminals and merges."""

import datetime as dt
import random

from granary.plans import chains

NOW = dt.datetime(2024, 5, 1, 8, 0, 0)
BEFORE = dt.datetime(2024, 4, 1, 8, 0, 0)
LOG = "pl_udate date, pl_utime string, pl_rsnum bigint, pl_rspos bigint, pl_rsnum_new bigint, pl_rspos_new bigint, load_id string"


def simulate(table, rows, now):
    """One row after the other, as stated by the rules."""
    table = dict(table)
    free = max((v[2] for v in table.values()), default=0) + 1
    for date, time, a, b, c, d in sorted(set(rows)):
        source, target = (a, b), (c, d)
        if target == (0, 0):
            if source not in table:
                table[source] = (date, time, free, now)
                free += 1
            continue
        known = [n for n in (source, target) if n in table]
        if not known:
            for node in {source, target}:
                table[node] = (date, time, free, now)
            free += 1
        elif len({source, target}) > len(set(known)):
            new = target if source in table else source
            table[new] = (date, time, table[known[0]][2], now)
        else:
            low, high = sorted((table[source][2], table[target][2]))
            if low != high:
                for node, (x, y, chain, _) in list(table.items()):
                    if chain == high:
                        table[node] = (x, y, low, now)
    return table


def random_log(seed, size, nodes):
    rng = random.Random(seed)
    hub = (1, 1)
    rows = []
    for _ in range(size):
        source = (rng.randint(1, nodes), rng.randint(1, 3))
        kind = rng.random()
        if kind < 0.1:
            target = (0, 0)
        elif kind < 0.15:
            target = source
        elif kind < 0.18:
            target = (0, rng.randint(1, 3))
        elif kind < 0.35 and seed % 2:
            source, target = rng.choice([(source, hub), (hub, source)])
        else:
            target = (max(1, source[0] + rng.choice([-1, 0, 1])), rng.randint(1, 3))
        date = dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 20))
        rows.append((date, f"{rng.randint(0, 23):02d}:00:00", *source, *target))
    return rows


def as_table(df):
    return {(r["plc_rsnum"], r["plc_rspos"]): (r["plc_udate"], r["plc_utime"], r["chain_id"], r["plc_lchg_date_time"]) for r in df.collect()}


def frame(spark, rows, load="L"):
    return spark.createDataFrame([(*r, load) for r in rows], LOG)


def run(spark, seed, size, nodes):
    first, second = random_log(seed, size, nodes), random_log(seed + 100, size, nodes)
    expected = simulate({}, first, BEFORE)
    got = chains.materialise(chains.extended_chains(chains.no_chains(spark), frame(spark, first), BEFORE), "first")
    assert as_table(got) == expected
    expected = simulate(expected, second, NOW)
    assert as_table(chains.extended_chains(got, frame(spark, second), NOW)) == expected


def test_sparse_log_in_two_loads(spark):
    run(spark, 2, 400, 300)


def test_hub_log(spark):
    run(spark, 3, 300, 150)


def test_small_cases(spark):
    day = dt.date(2024, 1, 1)
    old = [(day, "01", 1, 1, 2, 1), (day, "02", 3, 1, 4, 1), (day, "03", 9, 1, 0, 0), (day, "04", 8, 1, 8, 1)]
    table = simulate({}, old, BEFORE)
    merge = [(day, "05", 2, 1, 3, 1), (day, "06", 9, 1, 0, 0), (day, "07", 7, 1, 0, 1)]
    expected = simulate(table, merge, NOW)
    chain = chains.materialise(chains.extended_chains(chains.no_chains(spark), frame(spark, old), BEFORE), "old")
    null_key = [(day, "08", 5, 1, None, 1)]
    got = as_table(chains.extended_chains(chain, frame(spark, merge + null_key), NOW))
    assert got == expected
    # The merged chain takes the smaller number and a new stamp; others keep theirs.
    assert got[(3, 1)][2] == got[(1, 1)][2] == 1
    assert got[(3, 1)][3] == NOW and got[(1, 1)][3] == BEFORE and got[(8, 1)][3] == BEFORE


def test_empty_load_changes_nothing(spark):
    day = dt.date(2024, 1, 1)
    chain = chains.materialise(chains.extended_chains(chains.no_chains(spark), frame(spark, [(day, "01", 1, 1, 2, 1)]), BEFORE), "one")
    assert as_table(chains.extended_chains(chain, frame(spark, []), NOW)) == as_table(chain)
