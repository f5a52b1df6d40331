"""The models: staging, intermediate, star schema, detectors, checks, metrics, serving tables."""
