"""Scans of the raw export and of warehouse tables, plus derived test inputs."""
