"""Column types of every table, declared and never inferred."""

VIDEOS = "video_id string, path string, duration_s double, fps double, width int, height int, audio boolean, checksum string, split string"
CLIPS = "clip_id string, video_id string, start_s double, end_s double, frame_start int, frame_end int, overlap_s double, scenedetect_failed boolean, status string, last_error string, retry_count int"
STATE = "clip_id string, video_id string, status string, last_error string, retry_count int, seq long, updated_at double"
DEAD_LETTERS = "clip_id string, video_id string, error string, updated_at double"
MASKS = "frame_index long, timestamp_s double, mask_rle string"
POSES = "frame_index long, timestamp_s double, pose array<float>"
ARTIFACTS = {"masks": MASKS, "hand_pose": POSES, "object_pose": POSES, "mapping": POSES, "fast3r_pose": POSES}

#: The columns of a clip's task that describe it.
TASK = ("clip_id", "video_id", "video_path", "start_s", "end_s", "frame_start", "frame_end", "scenedetect_failed", "retry_count")

#: What the columns of manifests and artifacts mean.
FIELDS = {
    "video_id": "identifier of a video", "clip_id": "identifier of a clip: video, frames, hash", "start_s": "first second, on a frame", "end_s": "last second, on a frame",
    "frame_start": "first frame, from 0", "frame_end": "last frame", "fps": "frames a second", "duration_s": "seconds", "frame_index": "frame of the source video, from 0",
    "timestamp_s": "frame_index / fps", "mask_rle": "column-major run lengths at source resolution", "pose": "camera frame, right-handed, meters, wxyz",
}
