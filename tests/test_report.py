"""An updated report equals a whole merge; days without new trips are carried over as they are."""

from datetime import datetime, timezone

import pytest

from fareflow.plans.load import load_new_files, mark_published, stored_listing
from fareflow.plans.report import add_batch_sums, merge_batch_sums, update_report
from fareflow.sources.ledger import read_ledger, unpublished_batches
from tests.test_load import at, line, put  # noqa: F401

TIMES = [datetime(2024, 1, 1 + k, tzinfo=timezone.utc) for k in range(4)]


def load(spark, to):
    load_new_files(spark, to.raw, to.lake, to.ledger)
    book = read_ledger(spark, to.ledger)
    add_batch_sums(spark, to.lake, book, to.sums)
    return stored_listing(unpublished_batches(book))


def rows(report):
    return {r.date.day: (r.total_trips, r.total_revenue, r.avg_speed_mph, r.calculated_at.day) for r in report.collect()}


def whole(spark, to):
    report = merge_batch_sums(spark, read_ledger(spark, to.ledger), to.sums, f"{to.report}-whole", TIMES[0])
    return {day: measures[:3] for day, measures in rows(report).items()}


def test_only_days_of_new_batches_are_rewritten(spark, at):
    raw, to = at
    steps = [([1, 1, 5, 9], {1: 1, 5: 1, 9: 1}), ([5, 7], {1: 1, 5: 2, 7: 2, 9: 1}), ([9], {1: 1, 5: 2, 7: 2, 9: 3})]
    for k, (days, calculated) in enumerate(steps):
        put(raw, f"{k}.csv", *[line(day, 1.0 + k) for day in days])
        fresh = load(spark, to)
        report, rewritten = update_report(spark, to.ledger, to.sums, to.report, fresh, TIMES[k])
        mark_published(spark, to.ledger, fresh)
        assert rewritten == len(set(days))
        found = rows(report)
        assert {day: m[3] for day, m in found.items()} == calculated
        assert {day: m[:3] for day, m in found.items()} == whole(spark, to)


def test_repeated_and_empty_updates_change_nothing(spark, at):
    raw, to = at
    put(raw, "a.csv", line(1), line(2))
    fresh = load(spark, to)
    for _ in range(2):  # as after a run that died before it published
        report, rewritten = update_report(spark, to.ledger, to.sums, to.report, fresh, TIMES[0])
        assert rewritten == 2 and rows(report)[1][0] == 1
    mark_published(spark, to.ledger, fresh)
    report, rewritten = update_report(spark, to.ledger, to.sums, to.report, fresh.limit(0), TIMES[1])
    assert rewritten == 0 and {m[3] for m in rows(report).values()} == {1} and len(rows(report)) == 2


def test_update_planned_before_another_loses_nothing(spark, at):
    raw, to = at
    put(raw, "a.csv", line(1))
    first = load(spark, to)
    put(raw, "b.csv", line(1), line(2))
    second = load(spark, to)
    update_report(spark, to.ledger, to.sums, to.report, second, TIMES[0])
    report, _ = update_report(spark, to.ledger, to.sums, to.report, first, TIMES[1])
    assert {day: m[:3] for day, m in rows(report).items()} == whole(spark, to)
