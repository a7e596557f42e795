"""Tables of the engine and their integrity rules."""

from __future__ import annotations

# Column lists as DDL strings, so that readers can be given an explicit schema.
TABLES = {
    "documents": "id bigint, content string, embedding array<float>, source string, source_type string, era string, figures array<string>, chunk_index int, word_count int, created_at timestamp_ntz, metadata string",
    "chunk_metadata": "id bigint, chunk_id bigint, figure_ids array<bigint>, event_id bigint, account_type string, chain_strength string, conflict_flag boolean, conflict_note string, noise_flag boolean, created_at timestamp_ntz",
    "figures": "id bigint, name string, name_variants array<string>, sensitivity_tier string, era array<string>, series array<string>, birth_death string, dramatic_question string, primary_sources array<string>, generation string, tabaqat_volume int, sahabi_categories array<string>, bayah_pledges array<string>, known_for string, primary_hadith_count int, death_circumstance string",
    "events": "id bigint, name string, name_variants array<string>, date_ce string, date_ah string, location string, era string, figure_ids array<bigint>, significance string, date_ce_year int",
    "figure_relationships": "id bigint, figure_a_id bigint, figure_b_id bigint, relationship string, description string, resolution string",
    "figure_lineage": "id bigint, figure_id bigint, related_id bigint, related_name string, lineage_type string, direction string, divergence string, notes string",
    "scholarly_debates": "id bigint, topic string, event_id bigint, figure_id bigint, position_a string, position_b string, key_scholars array<string>, script_instruction string",
    "source_relationships": "id bigint, source_a string, source_b string, event_id bigint, relationship string, conflict_note string, reliability_note string, scholarly_consensus string, topic string, position_a string, position_b string, reconciliation string, script_instruction string, dramatic_weight string",
    "sources": "name string, short_name string, source_type string, language string, translator string, era_coverage array<string>, reliability string, chunk_count int",
    "api_keys": "id bigint, key_hash string, name string, tier string, query_count int, month_count int, month_reset date, active boolean, created_at timestamp_ntz, user_id string",
    "api_usage": "id bigint, api_key string, endpoint string, model string, tokens_in int, tokens_out int, created_at timestamp_ntz, user_id string, month_bucket string",
    "query_telemetry": "query_text string, query_hash binary, turn_index int, retrieval_mode string, candidates_fts int, candidates_vec int, rrf_top_ids array<bigint>, rrf_top_scores array<double>, top_figure_ids array<bigint>, top_sources array<string>, answered boolean, refusal_reason string, citations_count int, latency_ms int, tokens_in int, tokens_out int, model string, pii_flagged boolean",
    "themes": "id bigint, slug string, name string, description string",
    "figure_themes": "figure_id bigint, theme_id bigint, relevance string",
    "figure_motivations": "figure_id bigint, motivation string, is_primary boolean",
    "figure_deaths": "figure_id bigint, last_words string",
    "figure_quotes": "figure_id bigint, quote string, chain_strength string",
    "event_causes": "cause_event_id bigint, effect_event_id bigint, time_gap_years int",
    "event_geography": "event_id bigint, place string",
    "political_factions": "id bigint, name string, ideology string",
    "figure_factions": "figure_id bigint, faction_id bigint, joined_date string",
    "political_betrayals": "betrayer_id bigint, betrayed_id bigint",
    "alliance_reversals": "figure_id bigint, from_faction_id bigint, to_faction_id bigint",
}

# The allowed values of enumerated columns.
ENUMS = {
    ("chunk_metadata", "account_type"): ("eyewitness", "transmitted", "later_compilation", "commentary"),
    ("chunk_metadata", "chain_strength"): ("sahih", "hasan", "daif", "unknown", "scholarly"),
    ("figures", "sensitivity_tier"): ("S", "A", "B", "C"),
    ("figures", "generation"): ("sahabi", "tabi_i", "tabi_al_tabi_in", "later"),
    ("figures", "death_circumstance"): ("battle", "plague", "martyrdom", "natural", "executed", "assassinated", "unknown"),
    ("figure_relationships", "relationship"): ("ALLY", "ANTAGONIST", "RIVAL", "MUTUAL_RESPECT", "IDEOLOGICAL_OPPONENT", "PARALLEL", "POLITICAL_OPPONENT"),
    ("figure_relationships", "resolution"): ("RECONCILED", "UNRESOLVED", "VICTORY_A", "VICTORY_B", "MUTUAL_DESTRUCTION", "TRANSCENDED", "DEATH_ENDED_IT"),
    ("figure_lineage", "lineage_type"): ("BIOLOGICAL", "POLITICAL_HEIR", "MILITARY_PATRON", "INTELLECTUAL", "SUFI_SILSILA"),
    ("figure_lineage", "direction"): ("ancestor", "descendant"),
    ("figure_lineage", "divergence"): ("SURPASSED", "BETRAYED", "COMPLETED", "CORRUPTED", "ABANDONED", "MARTYRED"),
    ("source_relationships", "relationship"): ("CORROBORATES", "CONTRADICTS", "SUPPLEMENTS", "CHALLENGES", "EARLIER_ACCOUNT", "LATER_COMPILATION"),
    ("source_relationships", "dramatic_weight"): ("LOW", "MEDIUM", "HIGH", "CRITICAL"),
}
UNIQUE = {
    "figures": (("name",),), "events": (("name",),), "api_keys": (("key_hash",),), "sources": (("short_name",),),
    "figure_relationships": (("figure_a_id", "figure_b_id", "relationship"),),
}
FOREIGN = {
    ("chunk_metadata", "chunk_id"): "documents", ("chunk_metadata", "event_id"): "events",
    ("figure_relationships", "figure_a_id"): "figures", ("figure_relationships", "figure_b_id"): "figures",
    ("figure_lineage", "figure_id"): "figures", ("figure_lineage", "related_id"): "figures",
    ("scholarly_debates", "event_id"): "events", ("scholarly_debates", "figure_id"): "figures",
    ("source_relationships", "event_id"): "events",
}
