"""Run configuration: defaults, source overrides, checks, and the keys that plans join on."""

from __future__ import annotations

import ipaddress
import json
import os
import re
from dataclasses import dataclass
from typing import Any

from ..functions.geo import Policy, Rules
from ..operators.run import Settings, SourceSettings

# The documented defaults, allowed words and public resolvers.
DEFAULTS: dict[str, Any] = {
    "fetch": {"request_timeout": 30.0},
    "dns": {"enabled": True, "nameservers": [], "timeout": 5.0, "ecs": {"enabled": False, "subnet": "", "scope_prefix_length": 0}},
    "rdap": {"timeout": 10.0},
    "geo": {
        "enabled": False, "provider": "", "timeout": 5.0, "cache_ttl_days": 7, "token": "",
        "policy": {"enabled": False, "match_scope": "any_ip", "include": {"countries": [], "regions": []}, "exclude": {"countries": [], "regions": []}},
    },
    "output": {"directory": "output"},
}
CACHE_DEFAULTS: dict[str, Any] = {
    "classification_ttl_days": {"rdap_registrable_domain_unregistered": 7, "rdap_registrable_domain_registered": 7, "rdap_lookup_unavailable": 7},
    "dns_ttl_days": 1,
}
FORMATS = ["auto", "plain", "hosts", "adblock", "dnsmasq"]
GOOGLE_DNS = ["8.8.8.8", "8.8.4.4", "2001:4860:4860::8888", "2001:4860:4860::8844"]
QUAD9_ECS_DNS = ["9.9.9.11", "149.112.112.11", "2620:fe::11", "2620:fe::fe:11"]
ISO_REGION = re.compile(r"[A-Z]{2}-[A-Z0-9]{1,3}")
TOKEN_VARIABLE = "GEO_IPINFO_TOKEN"


class ConfigError(ValueError):
    pass


def nested(base: dict, over: dict) -> dict:
    """``base`` with the values of ``over``; tables are merged, anything else is replaced."""
    return {k: nested(base[k], over[k]) if k in over and isinstance(base.get(k), dict) and isinstance(over[k], dict) else over.get(k, base.get(k)) for k in [*base, *[k for k in over if k not in base]]}


def _known(value: dict, shape: dict, where: str) -> None:
    for k, v in value.items():
        if k not in shape:
            raise ConfigError(f"{where}.{k} is not a setting")
        if isinstance(shape[k], dict) and isinstance(v, dict):
            _known(v, shape[k], f"{where}.{k}")


def _address(text: str) -> str:
    try:
        return str(ipaddress.ip_address(text.strip()))
    except ValueError as e:
        raise ConfigError(f"dns.nameservers: {text!r} is not an IP address") from e


def _checked_dns(dns: dict) -> dict:
    ecs = dict(dns["ecs"])
    if ecs["subnet"].strip():
        try:
            net = ipaddress.ip_network(ecs["subnet"].strip(), strict=False)
        except ValueError as e:
            raise ConfigError("dns.ecs.subnet is not a subnet") from e
        ecs["subnet"] = net.with_prefixlen
        if ecs["enabled"] and not 0 <= ecs["scope_prefix_length"] <= net.max_prefixlen:
            raise ConfigError("dns.ecs.scope_prefix_length is outside the subnet's family")
    elif ecs["enabled"]:
        raise ConfigError("dns.ecs.enabled needs dns.ecs.subnet")
    return dns | {"nameservers": [_address(a) for a in dns["nameservers"]], "ecs": ecs}


def region_rules(values: list[str]) -> tuple[list[str], list[str]]:
    """(region codes, region names) of mixed rules."""
    codes = [v.strip().upper() for v in values if ISO_REGION.fullmatch(v.strip().upper())]
    names = [" ".join(v.split()).casefold() for v in values if not ISO_REGION.fullmatch(v.strip().upper())]
    return codes, names


def geo_provider(geo: dict) -> str:
    """The service that the rules ask for, whatever the setting names: only one of them knows regions."""
    policy = geo["policy"]
    return "geojs" if policy["include"]["regions"] or policy["exclude"]["regions"] else "ipinfo_lite"


def _checked_geo(geo: dict, dns: dict, where: str) -> None:
    if not geo["enabled"]:
        return
    if not dns["enabled"]:
        raise ConfigError(f"{where}: geo.enabled needs dns.enabled")
    if geo_provider(geo) == "geojs":
        for side in ("include", "exclude"):
            if codes := region_rules(geo["policy"][side]["regions"])[0]:
                raise ConfigError(f"{where}: geo.policy.{side}.regions holds the code {codes[0]}; only names can be looked up")
    elif not (os.environ.get(TOKEN_VARIABLE, "").strip() or geo["token"].strip()):
        raise ConfigError(f"{where}: geo needs {TOKEN_VARIABLE} or geo.token")


@dataclass(frozen=True)
class Source:
    id: str
    index: int
    enabled: bool
    input: dict
    settings: dict

    @property
    def label(self) -> str:
        return self.input["label"] or self.input["location"]

    def policy(self) -> Policy:
        p = self.settings["geo"]["policy"]
        side = lambda s: Rules([c.strip().upper() for c in p[s]["countries"]], *region_rules(p[s]["regions"]))
        return Policy(p["enabled"], p["match_scope"], side("include"), side("exclude"))

    def resolver_key(self) -> str:
        return resolver_key(self.settings["dns"])

    def execution_profile(self) -> str:
        """Sources may share a host only if these settings agree."""
        return json.dumps({k: self.settings[k] for k in ("dns", "rdap", "geo")}, sort_keys=True)

    def rdap_profile(self) -> str:
        return json.dumps(self.settings["rdap"], sort_keys=True)

    def run_settings(self) -> SourceSettings:
        geo = self.settings["geo"]
        return SourceSettings(
            self.settings["dns"]["enabled"], geo["enabled"], self.resolver_key(), geo_provider(geo), geo["cache_ttl_days"],
            self.policy() if geo["enabled"] else Policy(enabled=False), self.execution_profile(), self.rdap_profile(),
        )


def resolvers(dns: dict) -> list[str]:
    """The resolvers that will be asked; with a client subnet all must support it."""
    own = list(dns["nameservers"])
    if dns["ecs"]["enabled"] and not (own and set(own) <= {_address(a) for a in GOOGLE_DNS + QUAD9_ECS_DNS}):
        return list(GOOGLE_DNS)
    return own


def resolver_key(dns: dict) -> str:
    ecs = dns["ecs"]
    subnet = f"ecs={ecs['subnet']}@{ecs['scope_prefix_length']}" if ecs["enabled"] else "ecs=off"
    return f"{','.join(resolvers(dns)) or 'system'}|{subnet}"


def parse_config(raw: dict) -> tuple[list[Source], dict]:
    """(sources with merged and checked settings, cache settings) of a version 2 document."""
    if raw.get("version") != 2:
        raise ConfigError("version must be 2")
    if not raw.get("sources"):
        raise ConfigError("at least one source is needed")
    _known(raw, {"version": 2, "defaults": DEFAULTS, "cache": CACHE_DEFAULTS, "sources": []}, "config")
    base = nested(DEFAULTS, raw.get("defaults") or {})
    sources, seen = [], set()
    for index, entry in enumerate(raw["sources"]):
        given = {k: v for k, v in entry.items() if k not in ("id", "enabled", "input")}
        name = str(entry.get("id", "")).strip()
        where = f"sources[{name!r}]"
        if not name or name in seen:
            raise ConfigError(f"{where}: ids must be given and differ")
        seen.add(name)
        _known(given, DEFAULTS, where)
        settings = nested(base, {k: v for k, v in given.items() if v is not None})
        settings["dns"] = _checked_dns(settings["dns"])
        source_in = {"format": "auto", "label": ""} | entry.get("input", {})
        source_in |= {"format": source_in["format"].strip().lower(), "label": source_in["label"].strip(), "location": str(source_in.get("location", "")).strip()}
        if source_in.get("type") not in ("file", "url") or not source_in["location"] or source_in["format"] not in FORMATS:
            raise ConfigError(f"{where}: input needs a type (file, url), a location and a format of {', '.join(FORMATS)}")
        enabled = bool(entry.get("enabled", True))
        if enabled:
            _checked_geo(settings["geo"], settings["dns"], where)
        sources.append(Source(name, index, enabled, source_in, settings))
    if len({os.path.realpath(s.settings["output"]["directory"]) for s in sources if s.enabled}) > 1:
        raise ConfigError("all sources must share one output directory")
    return sources, nested(CACHE_DEFAULTS, raw.get("cache") or {})


def run_settings(sources: list[Source], cache: dict) -> Settings:
    """Settings of a run over the enabled sources; rows that no source has take those of the first."""
    on = {s.id: s.run_settings() for s in sources if s.enabled}
    days = cache["classification_ttl_days"]
    return Settings(
        on, next(iter(on.values()), SourceSettings()), registered_days=days["rdap_registrable_domain_registered"], unregistered_days=days["rdap_registrable_domain_unregistered"],
        unavailable_days=days["rdap_lookup_unavailable"], dns_days=cache["dns_ttl_days"],
    )


def load_config(path: str) -> tuple[list[Source], dict]:
    import yaml

    with open(path, encoding="utf-8") as f:
        return parse_config(yaml.safe_load(f) or {})
