"""Inputs: flow messages and control tables."""

from netbaseline.sources.flows import (
    read_flow_messages, parse_flows, flows_from_events, messages_from_events,
)
from netbaseline.sources.control import (
    read_control_table, decode_profiles, group_members_from_events, modeling_params_fixture,
    param_versions_from_events,
)

__all__ = [
    "read_flow_messages", "parse_flows", "flows_from_events", "messages_from_events",
    "read_control_table", "decode_profiles", "group_members_from_events",
    "modeling_params_fixture", "param_versions_from_events",
]
