"""Engagement, communication and service scores, driven by tables of rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: names and points of the engagement pattern, by (messages, platform, meetings) being engaged
PATTERNS = {
    (1, 1, 1): ("SLACK + PLATFORM + MEETING", 90), (1, 1, 0): ("SLACK + PLATFORM", 80), (0, 1, 1): ("PLATFORM + MEETING", 75), (1, 0, 1): ("SLACK + MEETING", 60),
    (0, 1, 0): ("PLATFORM ONLY", 50), (0, 0, 1): ("MEETING ONLY", 40), (1, 0, 0): ("SLACK ONLY", 30),
}
NONE, NO_DATA = ("NO ENGAGEMENT", 20), "NO DATA"
#: All flags that are known are 0: these patterns of (messages, platform, meetings), None for unknown, count as no engagement.
SILENT = [(0, 0, 0), (0, 0, None), (None, 0, 0), (0, None, 0)]
SENTIMENT_POINTS = {"POSITIVE": 10, "NEUTRAL": 5, "NEGATIVE": -25}
BANDS = [(75, "GOOD"), (50, "AVERAGE")]


def recency_flag(days: Column, limit: int) -> Column:
    """1 within the limit, 0 beyond, null when unknown."""
    return (days <= limit).cast("int")


def _is(c: Column, value) -> Column:
    return c.isNull() if value is None else c.eqNullSafe(F.lit(value))


def engagement_pattern(flags: Sequence[Column]) -> Column:
    """The pattern's name from three nullable flags: unknown counts as not engaged where another flag is 1."""
    on = [F.coalesce(f, F.lit(0)) for f in flags]
    out = F.lit(NO_DATA)
    for silent in SILENT:
        test = _is(flags[0], silent[0]) & _is(flags[1], silent[1]) & _is(flags[2], silent[2])
        out = F.when(test, NONE[0]).otherwise(out)
    for key, (name, _) in PATTERNS.items():
        out = F.when((on[0] == key[0]) & (on[1] == key[1]) & (on[2] == key[2]), name).otherwise(out)
    return out


def points(c: Column, table: dict, default: int | None = 0) -> Column:
    out = F.lit(default).cast("int")
    for value, p in table.items():
        out = F.when(c == value, F.lit(p)).otherwise(out)
    return out


def money(c: Column) -> Column:
    """The number in a text of money; null when there is none."""
    return F.regexp_replace(c.cast("string"), "[^0-9.]", "").try_cast("double")


def engagement_score(df: DataFrame, *, message: str = "days_message", login: str = "days_login", meeting: str = "days_meeting", booking: str = "days_booking", missed: str = "missed", sentiment: str = "sentiment") -> DataFrame:
    """``df`` with the three flags, engagement_pattern, base_score, final_score and health_band.

    The meeting flag needs both of its sources, and either within 30 days. Adjustments: missed calls (none 5, one or two 0, more -15) and
    sentiment. Without data there is no score.
    """
    both = F.col(meeting).isNotNull() & F.col(booking).isNotNull()
    flags = {"message_flag": recency_flag(F.col(message), 14), "platform_flag": recency_flag(F.col(login), 14), "meeting_flag": F.when(both, recency_flag(F.least(meeting, booking), 30))}
    df = df.withColumns(flags).withColumn("engagement_pattern", engagement_pattern([F.col(f) for f in flags]))
    base = points(F.col("engagement_pattern"), {**dict(PATTERNS.values()), NONE[0]: NONE[1]}, None)
    calls = F.when(F.col(missed) == 0, 5).when(F.col(missed) >= 3, -15).otherwise(0)
    df = df.withColumn("base_score", base).withColumn("final_score", F.col("base_score") + calls + points(F.upper(F.trim(sentiment)), SENTIMENT_POINTS))
    band = F.lit("POOR")
    for limit, name in reversed(BANDS):
        band = F.when(F.col("final_score") >= limit, name).otherwise(band)
    return df.withColumn("health_band", F.when(F.col("final_score").isNull(), NO_DATA).otherwise(band))


def last_days(df: DataFrame, key: str, ts: str, tests: dict[str, Column], *, as_of) -> DataFrame:
    """(key, a column of days for each test): the latest row that passes, all in one aggregate."""
    day = F.lit(str(as_of)).cast("date")
    return df.groupBy(key).agg(*[F.datediff(day, F.max(F.when(t, F.to_date(ts)))).alias(n) for n, t in tests.items()])


def _act(**want) -> Column:
    out = F.lit(True)
    for c, v in want.items():
        out &= F.col(c).isin(*v) if isinstance(v, tuple) else F.col(c) == v
    return out


def turn(inbound: Column, outbound: Column, *, ours: str, theirs: str, even: str) -> Column:
    """Whose turn it is: the side that did not speak last; null when nobody spoke."""
    far = F.lit(1 << 30)
    i, o = F.coalesce(inbound, far), F.coalesce(outbound, far)
    return F.when(inbound.isNull() & outbound.isNull(), None).when(i < o, ours).when(o < i, theirs).otherwise(even)


def communication_state(acts: DataFrame, signals: DataFrame | None, *, as_of, window: int = 14, key: str = "lead_id", ts: str = "activity_at") -> DataFrame:
    """Days since each channel's last in and out, contact and attempt, whose turn it is, and whether every channel was tried.

    ``signals`` has days for one more channel: key, in_days, out_days.
    """
    tests = {
        "in_email_days": _act(type="Email", status="inbox"), "out_email_days": _act(type="Email", status="sent"), "in_call_days": _act(type="Call", direction="inbound"),
        "out_call_days": _act(type="Call", direction="outbound"), "call_connected_days": _act(type="Call", disposition="answered"),
        "missed_client_call_days": _act(type="Call", direction="inbound", disposition="no-answer"), "in_sms_days": _act(type="SMS", direction="inbound"),
        "out_sms_days": _act(type="SMS", direction="outbound"), "other_days": F.col("type").isin("Meeting", "Note", "CustomActivity"),
    }
    days = last_days(acts, key, ts, tests, as_of=as_of)
    if signals is None:
        days = days.withColumns({"in_slack_days": F.lit(None).cast("int"), "out_slack_days": F.lit(None).cast("int")})
    else:
        s = signals.where("in_days IS NOT NULL OR out_days IS NOT NULL").select(key, F.col("in_days").alias("in_slack_days"), F.col("out_days").alias("out_slack_days"))
        days = days.join(s, key, "full_outer")
    days = days.withColumns({
        "client_reach_days": F.least("in_email_days", "in_call_days", "in_sms_days", "in_slack_days"),
        "we_connected_days": F.least("out_email_days", "out_sms_days", "call_connected_days", "out_slack_days"),
        "we_attempted_days": F.least("out_email_days", "out_sms_days", "out_call_days", "out_slack_days"),
    })
    tried = F.greatest(*[F.coalesce(c, F.lit(1 << 30)) for c in ("out_call_days", "out_email_days", "out_sms_days")]) <= window
    silent = F.coalesce(F.col("client_reach_days"), F.lit(1 << 30)) > window
    return days.withColumns({"whose_turn": turn(F.col("client_reach_days"), F.col("we_connected_days"), ours="US", theirs="CLIENT", even="CURRENT"), "all_out_attempted": tried & silent})


# fixed values: bands of waiting time in days
WAITING = ([3, 7, 14, 30], ["0-3 days (live queue)", "4-7 days", "8-14 days", "15-30 days", "> 30 days (dropped)"])


def waiting_backlog(state: DataFrame, clients: DataFrame, *, key: str = "lead_id") -> DataFrame:
    """(waiting_since, never_connected, never_attempted, leads) of those who wait for us and are no clients."""
    from strata.operators.metrics import bucketize

    waiting = state.join(clients.select(key).distinct(), key, "left_anti").where("whose_turn = 'US'")
    band = bucketize(F.col("client_reach_days"), *WAITING)
    return waiting.groupBy(band.alias("waiting_since"), F.col("we_connected_days").isNull().alias("never_connected"), F.col("we_attempted_days").isNull().alias("never_attempted")).agg(F.count("*").alias("leads"))


def communication_recency(acts: DataFrame, signals: DataFrame, clients: DataFrame, *, as_of, key: str = "lead_id", ts: str = "activity_at") -> DataFrame:
    """Each client's days by channel, contacts and attempts, whose turn it is in five values, and whether outreach is exhausted."""
    answered, reached = F.col("disposition") == "answered", F.col("disposition").isin("answered", "vm-left")
    no = lambda c: ~F.coalesce(c, F.lit(False))
    tests = {
        "email_in_days": _act(type="Email", status="inbox"), "email_out_days": _act(type="Email", status="sent"), "email_attempt_days": _act(type="Email", status=("draft", "outbox", "scheduled")),
        "call_in_answered_days": _act(type="Call", direction="inbound") & answered, "call_in_unanswered_days": _act(type="Call", direction="inbound") & no(answered),
        "call_out_contact_days": _act(type="Call", direction="outbound") & reached, "call_out_attempt_days": _act(type="Call", direction="outbound") & no(reached),
        "text_in_days": _act(type="SMS", direction="inbound"), "text_out_days": _act(type="SMS", direction="outbound"), "meeting_days": _act(type="Meeting"),
        "other_activity_days": ~F.col("type").isin("Email", "Call", "SMS", "Meeting"), "any_activity_days": F.lit(True),
    }
    days = last_days(acts.where("type IS NOT NULL"), key, ts, tests, as_of=as_of)
    s = signals.select(key, F.col("in_days").alias("slack_in_days"), F.col("out_days").alias("slack_out_days"))
    df = clients.select(key).distinct().join(days, key, "left").join(s, key, "left")
    df = df.withColumns({
        "last_contact_in_days": F.least("email_in_days", "call_in_answered_days", "call_in_unanswered_days", "text_in_days", "slack_in_days", "meeting_days"),
        "last_contact_out_days": F.least("email_out_days", "call_out_contact_days", "text_out_days", "slack_out_days", "meeting_days"),
        "last_attempt_days": F.least("email_attempt_days", "call_out_attempt_days"),
        "channels_out_14d": sum((F.coalesce((F.least(*map(F.col, cs)) if len(cs) > 1 else F.col(cs[0])) <= 14, F.lit(False)).cast("int") for cs in (("email_out_days", "email_attempt_days"), ("call_out_contact_days", "call_out_attempt_days"), ("text_out_days",), ("slack_out_days",))), F.lit(0)),
    })
    whose = turn(F.col("last_contact_in_days"), F.col("last_contact_out_days"), ours="OUR TURN", theirs="THEIR TURN", even="MUTUAL")
    unheard = F.coalesce("last_contact_in_days", F.lit(1 << 30)) > 30
    return df.withColumns({
        "whose_turn": F.coalesce(whose, F.when(F.coalesce("any_activity_days", "slack_in_days", "slack_out_days").isNull(), "NO CONTACT").otherwise("NEVER REACHED")),
        "exhausted_outreach_flag": ((F.col("channels_out_14d") >= 3) & unheard).cast("int"),
    })


def turn_age_report(recency: DataFrame, days: Column, *by: str) -> DataFrame:
    """Clients by turn (and more) and the age of the last contact, with their share of the turn, in percent."""
    from strata.operators.metrics import bucketize, share_of_total

    aged = recency.withColumn("age", F.coalesce(bucketize(days, [3, 7, 14, 30, 90], ["0-3", "4-7", "8-14", "15-30", "31-90", "90+"]), F.lit("never")))
    return share_of_total(aged, ["whose_turn", *by, "age"], within=["whose_turn"])


# fixed values: points lost, and the ladder of verdicts by days a reply is owed
PENALTIES = {"day": 10, "day_most": 40, "no_attempt": 20, "overdue_30d": 40, "no_delivery": 30, "quiet": 10}
VERDICTS = [(2, "WITHIN THE PROMISE (0-2 days)"), (7, "PROMISE SLIPPING (3-7 days)"), (30, "PROMISE BROKEN (8-30 days)")]
KEPT, ABANDONED = "PROMISE KEPT", "PROMISE ABANDONED (31+ days)"


def service_score(clients: DataFrame, *, as_of, weights: dict | None = None) -> DataFrame:
    """``clients`` with what is owed to them, company_service_score (0 to 100) and service_verdict.

    Needs contract_value, sale_date, whose_turn, last_contact_in_days, last_contact_out_days, last_attempt_days, days_since_meeting,
    days_until_meeting.
    """
    w = PENALTIES | (weights or {})
    no = F.lit(False)
    owed = F.col("whose_turn") == "OUR TURN"
    waiting = F.when(owed, F.col("last_contact_in_days"))
    untried = owed & (F.col("last_attempt_days").isNull() | (F.col("last_attempt_days") >= F.col("last_contact_in_days")))
    flag = lambda c: F.coalesce(c, no).cast("int")
    df = clients.withColumns({
        "paying_client": F.coalesce(F.col("contract_value") > 0, no), "days_since_sale": F.datediff(F.lit(str(as_of)).cast("date"), F.col("sale_date")), "reply_owed": F.coalesce(owed, no),
        "days_awaiting_reply": waiting, "reply_days_past_promise": F.when(waiting > 2, waiting - 2), "no_attempt_since_reach": flag(untried), "promise_overdue_3d": flag(waiting >= 3),
        "promise_overdue_30d": flag((waiting > 30) & untried), "no_meeting_recorded_ever": F.col("days_since_meeting").isNull(), "no_meeting_scheduled": F.col("days_until_meeting").isNull(),
        "company_quiet_days": F.col("last_contact_out_days"), "company_minimal_service": (F.coalesce("last_contact_out_days", F.lit(1 << 30)) > 30).cast("int"),
    })
    df = df.withColumns({"paying_and_unanswered_30d": flag(F.col("paying_client") & (F.col("promise_overdue_30d") == 1)), "contract_without_delivery": flag(F.col("paying_client") & F.col("no_meeting_recorded_ever"))})
    lost = F.least(F.lit(w["day_most"]), w["day"] * F.coalesce("reply_days_past_promise", F.lit(0)))
    for c, name in (("no_attempt_since_reach", "no_attempt"), ("promise_overdue_30d", "overdue_30d"), ("contract_without_delivery", "no_delivery"), ("company_minimal_service", "quiet")):
        lost = lost + w[name] * F.col(c)
    verdict = F.lit(ABANDONED)
    for limit, name in reversed(VERDICTS):
        verdict = F.when(F.col("days_awaiting_reply") <= limit, name).otherwise(verdict)
    return df.withColumns({"company_service_score": F.greatest(F.lit(0), 100 - lost), "service_verdict": F.when(~F.col("reply_owed"), KEPT).otherwise(verdict)})


def _owner(owner: str) -> Column:
    return F.coalesce(F.nullif(F.col(owner), F.lit("")), F.lit("(unassigned)")).alias("owner")


def service_rollups(scored: DataFrame, *, owner: str = "csm_name", key: str = "lead_id", worst: int = 15) -> dict[str, DataFrame]:
    """The reports over service_score, by name: ladder, dollars, beside, worst, by_owner, concentration, ladder_wide, ladder_long, bench."""
    from strata.operators.metrics import concentration

    steps = {"kept": KEPT, "within_promise": VERDICTS[0][1], "slipping": VERDICTS[1][1], "broken": VERDICTS[2][1], "abandoned": ABANDONED}
    value = F.coalesce("contract_value", F.lit(0.0))
    rows = scored.withColumn("owner", _owner(owner))
    n = F.count("*").alias("clients")
    by_owner = rows.groupBy("owner").agg(n, F.sum("promise_overdue_3d").alias("past_promise"), F.round(F.avg("company_service_score"), 1).alias("avg_score"))
    bench = by_owner.agg(F.count("*").alias("owners"), F.sum("clients").alias("clients"), F.round(F.avg("clients"), 1).alias("clients_per_owner"), F.max("clients").alias("largest_book"))
    return {
        "ladder": rows.groupBy("service_verdict").agg(n, F.round(F.avg("company_service_score"), 1).alias("avg_score")),
        "dollars": rows.where("paying_client").groupBy("service_verdict").agg(n, F.round(F.sum(value), 2).alias("dollars")),
        "beside": rows.groupBy("health_band", "service_verdict").agg(n, F.round(F.avg("final_score"), 1).alias("avg_health"), F.round(F.avg("company_service_score"), 1).alias("avg_service")),
        "worst": rows.orderBy("company_service_score", F.col("contract_value").desc_nulls_last(), key).limit(worst),
        "by_owner": by_owner,
        "concentration": concentration(rows, "owner", "promise_overdue_3d"),
        "ladder_wide": rows.groupBy("owner").agg(n, *[F.count_if(F.col("service_verdict") == v).alias(s) for s, v in steps.items()], F.round(F.avg("company_service_score"), 1).alias("avg_score")),
        "ladder_long": rows.groupBy("owner", "service_verdict").agg(n),
        "bench": bench,
    }
