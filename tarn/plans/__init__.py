"""Configuration, metric plans, guards, manifests and the engine that ties operators together."""
