"""DataFrame -> DataFrame operators: daily metrics, reports, summary, alerts, rules."""
