"""Plans: stages with a manifest, and sinks that commit whole tables."""
