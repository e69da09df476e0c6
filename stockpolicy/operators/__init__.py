"""Set-based operators: staging, marts, series statistics, segmentation, policy, gates."""
