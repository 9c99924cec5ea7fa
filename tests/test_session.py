"""A submitted master and submitted settings survive ``get_spark``; the launcher's waiting."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_submitted_settings_hold():
    code = ("from pulseward.session import get_spark; s = get_spark(); c = s.sparkContext; "
            "print('GOT', c.master, s.conf.get('spark.sql.shuffle.partitions'), "
            "s.conf.get('spark.sql.adaptive.autoBroadcastJoinThreshold'), s.conf.get('spark.sql.session.timeZone'))")
    submitted = ("--master local[2] --conf spark.sql.shuffle.partitions=33 "
                 "--conf spark.sql.adaptive.autoBroadcastJoinThreshold=1MB pyspark-shell")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120,
                         env={**os.environ, "PYSPARK_SUBMIT_ARGS": submitted})
    assert "GOT local[2] 33 1MB UTC" in out.stdout, out.stdout + out.stderr[-1500:]


class Query:
    def __init__(self, turns, error=None):
        self.turns, self.error, self.stopped = turns, error, False

    @property
    def isActive(self):
        return self.turns > 0 and not self.stopped

    def exception(self):
        return self.error if self.turns <= 0 else None

    def stop(self):
        self.stopped = True


class Streams:
    def __init__(self, queries):
        self.queries = queries

    def awaitAnyTermination(self):
        for q in self.queries:
            q.turns -= 1
            if q.turns == 0 and q.error:
                raise q.error

    def resetTerminated(self):
        pass


class Session:
    def __init__(self, queries):
        self.streams = Streams(queries)


def test_launcher_waits_for_all_and_stops_the_rest_on_a_failure():
    from pulseward.streaming.__main__ import wait_for_all
    done = [Query(1), Query(3)]
    wait_for_all(Session(done), done)
    assert not any(q.isActive for q in done)
    failing = [Query(100), Query(2, RuntimeError("sink"))]
    with pytest.raises(RuntimeError):
        wait_for_all(Session(failing), failing)
    assert failing[0].stopped
