"""The jobs: events, silver, marts, article index, briefings, daily run."""
