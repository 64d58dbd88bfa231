"""Live fan-out: which clients receive which live message.

A message is not copied per client. It is routed to audiences: `*` (clients that follow every
device) and the message's device (clients that follow it and are not in `*`). A client thus
receives each message once, and the routed rows do not grow with the number of clients.

Who a client is at a message's time follows from the client log: a connection starts with `*`, subscriptions
come and go while it is open, and closing it or connecting again ends all of them. `audience_intervals` turns the log
into intervals of membership, from which the `_asof` functions take the ones that hold when a message is sent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.times import iso
from tidewire.operators.asof import as_of, running_total
from tidewire.operators.joins import lookup_join
from tidewire.session import cut_lineage

EVERYTHING = "*"


def audience_members(subscription_log: DataFrame, clients: DataFrame) -> DataFrame:
    """(audience, client_id) after the last action per client and device; clients start with `*`."""
    seed = clients.select(
        "client_id", F.lit(EVERYTHING).alias("device_id"), F.lit(-1).cast("bigint").alias("seq"),
        F.lit("subscribe").alias("action"),
    )
    actions = subscription_log.select("client_id", "device_id", "seq", "action").unionByName(seed)
    current = (
        actions.groupBy("client_id", "device_id")
        .agg(F.max_by("action", "seq").alias("action"))
        .filter("action = 'subscribe'")
        .select(F.col("device_id").alias("audience"), "client_id")
    )
    everything = current.filter(F.col("audience") == EVERYTHING)
    single = current.filter(F.col("audience") != EVERYTHING)
    return everything.unionByName(single.join(everything.select("client_id"), "client_id", "left_anti"))


def telemetry_messages(feed: DataFrame, received: Column) -> DataFrame:
    data = F.to_json(
        F.struct(
            F.col("device_id").alias("deviceId"), "metrics", "tags", iso(F.col("timestamp")).alias("timestamp")
        )
    )
    return _envelope(feed, F.col("event_id"), "telemetry", data, received)


def alert_messages(alerts: DataFrame, received: Column) -> DataFrame:
    data = F.to_json(
        F.struct(
            F.col("alert_id").alias("alertId"), F.col("device_id").alias("deviceId"),
            F.col("rule_id").alias("ruleId"), "severity", "message", "value", "threshold",
            iso(F.col("triggered_at")).alias("triggeredAt"),
        )
    )
    return _envelope(alerts, F.col("alert_id"), "alert", data, received)


def _envelope(rows: DataFrame, message_id: Column, kind: str, data: Column, received: Column) -> DataFrame:
    return rows.select(
        message_id.alias("message_id"),
        "device_id",
        F.lit(kind).alias("type"),
        data.alias("data"),
        iso(received).alias("received_at"),
    )


def live_fanout(messages: DataFrame, members: DataFrame) -> DataFrame:
    """Messages per audience that has members, with the number of clients that receive it.

    A message without device reaches only the `*` audience.
    """
    sizes = members.groupBy("audience").agg(F.count("*").alias("n_clients"))
    return lookup_join(_routed(messages), sizes, ["audience"], ["message_id"], computed=True)


def audience_intervals(log: DataFrame) -> DataFrame:
    """(client_id, session, audience, opened, closed) from a log of (client_id, seq, at, action, device_id).

    Actions are connect, disconnect, subscribe and unsubscribe, in the order of `at` and `seq`. A member of `*` is in
    no other audience meanwhile. An interval holds from `opened` up to, not including, `closed` (null: still open).
    """
    log = cut_lineage(log.select("client_id", "seq", "at", "action", "device_id"), "client-log")
    marks = log.filter(F.col("action").isin("connect", "disconnect")).select("client_id", "seq", "at", F.struct("at", "seq").alias("until"))
    connects = log.filter(F.col("action") == "connect").select("client_id", "seq", "at", F.col("seq").alias("session"))
    by_seq = {"ties": ("seq",), "salt_by": ["seq"]}
    sessions = as_of(connects, marks, ["client_id"], "at", "at", ["until"], strict=True, ahead=True, **by_seq)
    sessions = cut_lineage(sessions, "sessions")

    wishes = log.filter(F.col("action").isin("subscribe", "unsubscribe")).dropna(subset=["device_id"])
    made = as_of(wishes, sessions, ["client_id"], "at", "at", ["session", "until"], **by_seq)
    made = made.filter("session IS NOT NULL").filter(F.col("until").isNull() | (F.struct("at", "seq") < F.col("until")))
    first = sessions.withColumns({"device_id": F.lit(EVERYTHING), "action": F.lit("subscribe")})
    states = made.unionByName(first).withColumn("follows", F.col("action") == "subscribe").drop("action")
    states = cut_lineage(states, "follows")

    # What a wish changes, and until when: the next change of the same device, or the end of the connection.
    of_device = ["client_id", "session", "device_id"]
    earlier = states.select(*of_device, "seq", "at", F.col("follows").alias("before"))
    changes = as_of(states, earlier, of_device, "at", "at", ["before"], strict=True, **by_seq)
    changes = cut_lineage(changes.filter(F.col("follows") != F.coalesce("before", F.lit(False))), "changes")
    later = changes.select(*of_device, "seq", "at", F.col("at").alias("next"))
    spans = as_of(changes, later, of_device, "at", "at", ["next"], strict=True, ahead=True, **by_seq)
    spans = spans.select(*of_device, "follows", F.col("at").alias("opened"), F.coalesce("next", "until.at").alias("closed"))
    spans = cut_lineage(spans.filter(F.col("closed").isNull() | (F.col("opened") < F.col("closed"))), "spans")

    everything = spans.filter((F.col("device_id") == EVERYTHING) & F.col("follows"))
    # A device counts while the connection is out of `*`.
    gaps = spans.filter((F.col("device_id") == EVERYTHING) & ~F.col("follows")).select(
        "client_id", "session", F.col("opened").alias("from"), F.col("closed").alias("to")
    )
    single = spans.filter((F.col("device_id") != EVERYTHING) & F.col("follows")).join(gaps, ["client_id", "session"])
    pieces = single.withColumns({"opened": F.greatest("opened", "from"), "closed": F.least("closed", "to")})
    pieces = pieces.filter(F.col("closed").isNull() | (F.col("opened") < F.col("closed")))
    columns = ["client_id", "session", F.col("device_id").alias("audience"), "opened", "closed"]
    return everything.select(*columns).unionByName(pieces.select(*columns))


def audience_sizes(intervals: DataFrame) -> DataFrame:
    """(audience, at, n_clients): the members of an audience from `at` on."""
    came = intervals.select("audience", F.col("opened").alias("at"), F.lit(1).alias("change"))
    went = intervals.filter("closed IS NOT NULL").select("audience", F.col("closed").alias("at"), F.lit(-1).alias("change"))
    return running_total(came.unionByName(went), ["audience"], "at", "change", "n_clients")


def _routed(messages: DataFrame) -> DataFrame:
    audiences = F.filter(F.array(F.lit(EVERYTHING), F.col("device_id")), lambda a: a.isNotNull())
    return messages.withColumn("audience", F.explode(F.array_distinct(audiences)))


def live_fanout_asof(messages: DataFrame, intervals: DataFrame) -> DataFrame:
    """Messages per audience that had members when the message was sent (`received_at`), with their number."""
    routed = _routed(messages).withColumn("sent", F.col("received_at").cast("timestamp"))
    sizes = cut_lineage(audience_sizes(intervals), "audience-sizes")
    found = as_of(routed, sizes, ["audience"], "sent", "at", ["n_clients"], salt_by=["message_id"])
    return found.filter("n_clients > 0").drop("sent")


def client_feed_asof(messages: DataFrame, intervals: DataFrame, client_id: str) -> DataFrame:
    """What one client received while it was connected."""
    mine = intervals.filter(F.col("client_id") == client_id)
    steps = mine.select("audience", F.col("opened").alias("at"), F.lit(True).alias("listens")).unionByName(
        mine.filter("closed IS NOT NULL").select("audience", F.col("closed").alias("at"), F.lit(False).alias("listens"))
    )
    # An audience left and joined again at one instant is not left.
    steps = cut_lineage(steps.groupBy("audience", "at").agg(F.max("listens").alias("listens")), "client-steps")
    routed = _routed(messages).withColumn("sent", F.col("received_at").cast("timestamp"))
    routed = lookup_join(routed, steps.select("audience").distinct(), ["audience"], ["message_id"], computed=True)
    found = as_of(routed, steps, ["audience"], "sent", "at", ["listens"], salt_by=["message_id"])
    return found.filter("listens").drop("sent", "listens")


def messages_sent(routed: DataFrame) -> DataFrame:
    """Copies sent to clients per message type."""
    return routed.groupBy("type").agg(F.sum("n_clients").alias("n"))


def client_feed(routed: DataFrame, members: DataFrame, client_id: str) -> DataFrame:
    """What one client receives."""
    mine = members.filter(F.col("client_id") == client_id).select("audience")
    return lookup_join(routed, mine, ["audience"], ["message_id"], computed=True)


def live_device_filter(messages: DataFrame, device_id: str) -> DataFrame:
    """Messages of one device (exact id); blank means all."""
    wanted = device_id.strip()
    return messages.filter(F.col("device_id") == wanted) if wanted else messages
