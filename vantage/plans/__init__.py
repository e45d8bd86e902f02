"""Named queries: summary tables, views, alerts, reports, panels, checks, actions."""
