"""All registered queries."""

from __future__ import annotations

from checks import defaults, forecasts, jobs, panel, streams, tables

QUERIES = {**panel.Q, **tables.Q, **forecasts.Q, **streams.Q, **jobs.Q, **defaults.Q}
