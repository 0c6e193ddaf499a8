"""Cleaning, windows and aggregation on small captures of our own."""

import pytest

from pktscope import schema as S
from pktscope.operators.packets import add_time_windows, aggregate_windows, clean_packets
from pktscope.plans.network import preprocess_windows

TEXT = [S.TIME_EPOCH, S.IP_SRC, S.IP_DST, S.SRC_PORT, S.DST_PORT, S.FLAG_SYN, S.FLAG_ACK, S.FLAG_FIN,
        S.FLAG_RST, S.FRAME_LEN, S.TIME_DELTA]


def capture(spark, rows):
    """Raw text rows; columns left out are NULL."""
    return spark.createDataFrame([tuple(r.get(c) for c in TEXT) for r in rows],
                                 ", ".join(f"{c} string" for c in TEXT))


def packet(epoch, src="fe80::1", dst="fe80::9", sport="40000", dport="8443", length="52", delta="0.25", **flags):
    names = {"syn": S.FLAG_SYN, "ack": S.FLAG_ACK, "fin": S.FLAG_FIN, "rst": S.FLAG_RST}
    return {S.TIME_EPOCH: epoch, S.IP_SRC: src, S.IP_DST: dst, S.SRC_PORT: sport, S.DST_PORT: dport,
            S.FRAME_LEN: length, S.TIME_DELTA: delta, **{names[k]: v for k, v in flags.items()}}


def test_flag_words_become_booleans(spark):
    rows = [packet("12", syn="true", fin="no"), packet("13", syn="TRUE", rst="yes"), packet("14", ack="tRuE")]
    out = clean_packets(capture(spark, rows)).orderBy(S.TIME_EPOCH)
    assert {out.schema[c].dataType.simpleString() for c in S.FLAG_COLUMNS} == {"boolean"}
    got = [tuple(r[c] for c in (S.FLAG_SYN, S.FLAG_ACK, S.FLAG_FIN, S.FLAG_RST)) for r in out.collect()]
    assert got == [(True, False, False, False), (True, False, False, False), (False, True, False, False)]


def test_packets_without_time_or_address_go(spark):
    rows = [packet("7.5"), packet(None), packet("8", src=None), packet("9", dst=None), packet("soon"),
            packet("10", length=None)]
    got = clean_packets(capture(spark, rows)).orderBy(S.TIME_EPOCH).collect()
    assert [r[S.TIME_EPOCH] for r in got] == [7.5, 10.0] and got[1][S.FRAME_LEN] is None


@pytest.mark.parametrize("seconds,keys", [(5, [-2, -1, 0, 0, 1, 4]), (0.5, [-12, -1, 0, 9, 10, 41])])
def test_window_keys_round_down(spark, seconds, keys):
    times = [-6.0, -0.25, 0.0, 4.9, 5.0, 20.75]
    df = spark.createDataFrame([(t,) for t in times], f"{S.TIME_EPOCH} double")
    got = add_time_windows(df, seconds).orderBy(S.TIME_EPOCH).collect()
    assert [r[S.TIME_WINDOW] for r in got] == keys


def test_window_length_must_be_positive(spark):
    with pytest.raises(ValueError):
        add_time_windows(capture(spark, []), 0)


def test_one_window_of_mixed_packets(spark):
    rows = [packet("60.5", sport="1", dport="22", syn="True", delta="0.5"),
            packet("61.0", sport="1", dport="23", syn="True", ack="True", delta="1.0", length="148"),
            packet("62.0", sport="2", dport="23", rst="True", fin="True", delta=None, length="junk"),
            packet("63.5", sport="3", dport="80", syn="True", delta="0.75", length="100"),
            packet("63.6", src="fe80::9", dst="fe80::1")]
    out = preprocess_windows(capture(spark, rows), window_seconds=60, min_packets=1)
    (r,) = out.where(f"{S.IP_SRC} = 'fe80::1'").collect()
    assert r[S.TIME_WINDOW] == 1 and out.count() == 2
    assert (r.syn_count, r.ack_count, r.rst_count, r.fin_count) == (3, 1, 1, 1)
    assert (r.unique_dst_ports, r.unique_src_ports, r.packet_count) == (3, 3, 3)
    assert (r.total_bytes, r.mean_packet_size) == (300.0, 100.0)
    assert (r.mean_time_delta, r.min_time_delta, r.max_time_delta) == (0.75, 0.5, 1.0)
    assert (r.window_start, r.window_end, r.window_duration) == (60.5, 63.5, 3.0)
    assert (r.syn_ack_ratio, r.syn_percentage, r.completion_ratio) == (1.5, 1.0, 0.5)
    assert r.ports_per_packet == 0.75 and r.packets_per_second == 3 / 3.001


@pytest.mark.parametrize("least,left", [(0, 3), (1, 2), (2, 1), (3, 1), (4, 0)])
def test_small_windows_go(spark, least, left):
    rows = [packet("5", dst="d"), packet("5", dst="e"), packet("6", dst="e"), packet("7", dst="e"),
            packet("5", dst="f", length="none at all")]
    df = add_time_windows(clean_packets(capture(spark, rows)), 100)
    assert aggregate_windows(df, min_packets=least).count() == left


def test_epoch_sized_deltas_do_not_fail(spark):
    rows = [packet("100", delta="1700000000.5") for _ in range(40)] + [packet("100", dst="x", delta="1e25"),
                                                                        packet("100", dst="x", delta="3e25")]
    got = {r[S.IP_DST]: r.mean_time_delta for r in preprocess_windows(capture(spark, rows), 10, 1).collect()}
    assert got == {"fe80::9": 1700000000.5, "x": 2e25}
