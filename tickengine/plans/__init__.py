"""Multi-step jobs: table maintenance, replay and the registered queries."""
