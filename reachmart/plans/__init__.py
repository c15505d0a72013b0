"""The jobs: staging, marts, reports, activation, repair, sync."""
