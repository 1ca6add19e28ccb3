"""Class names, their order and grouping, and the texts shown to reviewers.

All of these appear in outputs and must read exactly so.
"""

REGISTERED = "rdap_registrable_domain_registered"
UNREGISTERED = "rdap_registrable_domain_unregistered"
UNAVAILABLE = "rdap_lookup_unavailable"

PUBLIC_SUFFIX = "input_public_suffix"
PASSED = "manual_filter_passed"
PASS_NOT_IN_SOURCES = "manual_filter_pass_not_in_sources"
FILTER_OUT = "manual_filter_out"
OUT_NOT_IN_SOURCES = "manual_filter_out_not_in_sources"
ADD_REGISTERED = "manual_add_registered"
ADD_UNREGISTERED = "manual_add_unregistered"
ADD_UNAVAILABLE = "manual_add_unavailable"
REGISTERED_NO_DNS = "rdap_registrable_domain_registered_dns_disabled"
UNAVAILABLE_NO_DNS = "rdap_lookup_unavailable_dns_disabled"
TIMEOUT = "dns_lookup_timeout"
SERVFAIL = "dns_lookup_servfail"
APEX_NXDOMAIN = "dns_registered_apex_nxdomain"
APEX_NODATA = "dns_registered_apex_nodata"
SUB_NXDOMAIN = "dns_registered_subdomain_nxdomain"
SUB_NODATA = "dns_registered_subdomain_nodata"
RESOLVES = "dns_resolves"
NO_ADDRESSES = "dns_resolved_without_ip_addresses"
GEO_FAILED = "geo_lookup_failed"
GEO_NO_REGION = "geo_region_name_unavailable"
GEO_REJECTED = "geo_policy_rejected"

#: Registry status, class and the text for a reviewer, in order of precedence.
EPP = [
    ("inactive", "rdap_registered_domain_status_inactive", "RDAP status inactive indicates the domain should not resolve"),
    ("clienthold", "rdap_registered_domain_status_client_hold", "RDAP status clientHold indicates the domain should not resolve"),
    ("serverhold", "rdap_registered_domain_status_server_hold", "RDAP status serverHold indicates the domain should not resolve"),
    ("redemptionperiod", "rdap_registered_domain_status_redemption_period", "RDAP status redemptionPeriod indicates the domain is pending deletion"),
    ("pendingdelete", "rdap_registered_domain_status_pending_delete", "RDAP status pendingDelete indicates the domain is pending deletion"),
    ("pendingrestore", "rdap_registered_domain_status_pending_restore", "RDAP status pendingRestore indicates the domain is pending deletion"),
    ("pendingrenew", "rdap_registered_domain_status_pending_renew", "RDAP status pendingRenew indicates the domain is pending deletion"),
]
HOLD_OTHER = "rdap_registered_domain_status_hold_other"
DELETION_OTHER = "rdap_registered_domain_status_deletion_other"
RDAP_REVIEW = [c for _, c, _ in EPP] + [HOLD_OTHER, DELETION_OTHER]

#: Classes that end a row before geo.
PRE_GEO = [TIMEOUT, SERVFAIL, PASS_NOT_IN_SOURCES, FILTER_OUT, OUT_NOT_IN_SOURCES, APEX_NXDOMAIN, APEX_NODATA, NO_ADDRESSES, *RDAP_REVIEW]
GEO_REVIEW = [GEO_FAILED, GEO_NO_REGION, GEO_REJECTED]
DEAD = [UNREGISTERED]
REVIEW = [PUBLIC_SUFFIX, UNAVAILABLE_NO_DNS, ADD_UNREGISTERED, ADD_UNAVAILABLE, SUB_NXDOMAIN, SUB_NODATA, *PRE_GEO, *GEO_REVIEW]
FILTERED = [PASSED, ADD_REGISTERED, REGISTERED_NO_DNS, RESOLVES]

#: Texts that do not depend on the row; "{subject}" is filled from it.
REASONS = {
    PUBLIC_SUFFIX: "input is a public suffix rather than a registrable host",
    UNAVAILABLE_NO_DNS: "RDAP lookup was unavailable and DNS is disabled",
    TIMEOUT: "DNS lookup returned timeout",
    SERVFAIL: "DNS lookup returned servfail",
    PASS_NOT_IN_SOURCES: "manual filter-pass host was not present in any configured source",
    FILTER_OUT: "manual filter-out host was explicitly rejected",
    OUT_NOT_IN_SOURCES: "manual filter-out host was not present in any configured source",
    ADD_UNREGISTERED: "manual-add host has an RDAP-unregistered registrable domain",
    ADD_UNAVAILABLE: "manual-add host could not get an RDAP registration verdict",
    APEX_NXDOMAIN: "{subject} returned NXDOMAIN",
    APEX_NODATA: "{subject} has no A/AAAA answers",
    SUB_NXDOMAIN: "{subject} returned NXDOMAIN",
    SUB_NODATA: "{subject} has no A/AAAA answers",
    HOLD_OTHER: "an RDAP hold status indicates the domain should not resolve",
    DELETION_OTHER: "an RDAP deletion status indicates the domain is pending deletion",
    NO_ADDRESSES: "DNS did not produce resolved IPs for geo validation",
    GEO_FAILED: "geo lookup failed for all resolved IPs",
    GEO_NO_REGION: "resolved IPs lacked region names required by geo policy",
    **{c: text for _, c, text in EPP},
}

#: Columns of the review file, in file order.
REVIEW_COLUMNS = """input_name host registrable_domain classification classification_reason dns_status geo_status geo_reason
geo_policy_status geo_policy_reason geo_provider source_id source_input_label source_ids source_input_labels""".split()
IDENTITY_COLUMNS = """source_id source_input_label source_ids source_input_labels input_name host registrable_domain public_suffix
is_public_suffix_input input_kind apex_scope source_format""".split()
