"""Query plans: derived panels, end-to-end flows and the driver registry."""
