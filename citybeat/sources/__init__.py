"""Sources and sinks: trip file discovery and normalisation (trips), CSV /
GeoJSON reads and writes, size-capped parts with manifests (files)."""
